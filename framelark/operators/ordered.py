"""Ordered results of any length in parts: places and byte offsets of rows, documents and binaries that no task holds whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.operators.stretches import SIZE, Keys, numbered, running

#: Rows of a part of a document, and numbers of a part of a binary.
PART, NUMBERS = 10_000, 1 << 20


def laid_out(df: DataFrame, keys: Keys, order: str | list[str], size: str, place: str = "place", offset: str = "offset", stretch: int = SIZE) -> DataFrame:
    """df with each row's place in order among those of its keys, from 0, and its offset, the sum of the sizes before it.

    This is how k sorted inputs are merged: rows are dealt by ranges of the order, so no task sees a whole output. A null
    size counts as 0."""
    out = running(numbered(df, keys, order, place), keys, place, size, offset, stretch)
    return out.withColumn(offset, F.col(offset) - F.coalesce(F.col(size), F.lit(0)))


def document(items: DataFrame, keys: Keys, order: str | list[str], text: Column, head: Column | str = "[", tail: Column | str = "]", between: str = ",", part: int = PART) -> DataFrame:
    """(keys, part, offset, text): of each key a document, head + items joined by `between` + tail, in parts of `part` items.

    Parts joined in order are the document; offset counts the bytes before each. head and tail may be columns of keys.
    Every key that has rows gives a document; items whose text is null are in none, so a key with only such ones has
    head + tail."""
    rows = items.select(*keys, *([order] if isinstance(order, str) else order), text.alias("_text"))
    # null texts come last among their key's rows, so that places of the others have no gaps
    rows = numbered(rows.withColumn("_none", F.col("_text").isNull()), keys, ["_none", *([order] if isinstance(order, str) else order)], "_i", "_all")
    counted = rows.withColumn("part", F.floor(F.col("_i") / part).cast("long"))
    parts = counted.groupBy(*keys, "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_text").isNotNull(), F.struct("_i", "_text")))), lambda s: s["_text"]), between).alias("_joined"),
        F.count("_text").alias("_n"), (F.max("_i") + 1 == F.max("_all")).alias("_last"),
    )
    as_column = lambda c: c if isinstance(c, Column) else F.lit(c)
    start = F.when(F.col("part") == 0, as_column(head)).when(F.col("_n") > 0, F.lit(between)).otherwise(F.lit(""))
    parts = parts.withColumn("text", F.concat(start, "_joined", F.when(F.col("_last"), as_column(tail)).otherwise(F.lit(""))))
    sized = running(parts.withColumn("_size", F.octet_length("text").cast("long")), keys, "part", "_size", "offset")
    return sized.select(*keys, "part", (F.col("offset") - F.col("_size")).alias("offset"), "text")


def write_document(parts: DataFrame, path: str) -> None:
    """Text files in a folder for each id (parts has it as its only key): in the order of their names, lines without their
    ends, they are the document. Parts are dealt by ranges, so a document's files stand in the order of its parts."""
    dealt = parts.repartitionByRange("id", "part").sortWithinPartitions("id", "part")
    dealt.select("id", "text").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("id").text(path)


def numbers(rows: DataFrame, keys: Keys, order: str | list[str], value: str, part: int = NUMBERS, kind: str = "<f4") -> DataFrame:
    """(keys, part, offset, data): each key's values in order as numbers of `kind` (numpy's name), in parts of `part` numbers;
    offset counts bytes. Nulls become NaN."""
    width = np.dtype(kind).itemsize

    @F.pandas_udf("binary")
    def packed(values: pd.Series) -> pd.Series:
        return values.map(lambda v: np.asarray(v, np.float64).astype(kind).tobytes())

    columns = [order] if isinstance(order, str) else order
    placed = numbered(rows.select(*keys, *dict.fromkeys([*columns, value])), keys, columns, "_i").withColumn("part", F.floor(F.col("_i") / part).cast("long"))
    filled = F.coalesce(F.col(value).cast("double"), F.lit(float("nan")))
    groups = placed.groupBy(*keys, "part").agg(F.array_sort(F.collect_list(F.struct("_i", filled.alias("v")))).alias("_v"))
    return groups.select(*keys, "part", (F.col("part") * part * width).alias("offset"), packed(F.transform("_v", lambda s: s["v"])).alias("data"))


def read_numbers(parts: DataFrame, keys: Keys, kind: str = "<f4") -> DataFrame:
    """(keys, place, value) of what numbers() gave; place counts from 0 within each key."""
    width = np.dtype(kind).itemsize

    @F.pandas_udf("array<double>")
    def unpacked(data: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in data:
            yield part.map(lambda b: np.frombuffer(b, kind).astype(np.float64))

    rows = parts.select(*keys, "offset", F.posexplode(unpacked("data")).alias("_at", "value"))
    return rows.select(*keys, (F.col("offset") / width + F.col("_at")).cast("long").alias("place"), "value")
