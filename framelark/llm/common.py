"""What several text operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark.sources.shared import checkpointed, shared_folder

__all__ = ["checkpointed", "documents", "emptied", "given_back", "left_join_by_key", "let", "long_key", "own_tables", "written"]

#: A key that holds at least 1 / HOT_PARTS of all rows is hot; so there are at most HOT_PARTS hot keys.
HOT_PARTS = 1000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once for each row however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def long_key(value: Column) -> Column:
    """A long as eight bytes, in the order of its bits."""
    return F.unhex(F.lpad(F.hex(value), 16, "0"))


def left_join_by_key(rows: DataFrame, groups: DataFrame, key: str, size: str, light: Column | None = None) -> DataFrame:
    """rows with the columns of groups, which has one row for each binary key and counts in size how many of rows have it.

    Keys that hold at least a thousandth of all rows number a thousand at most, whatever the input: those few groups are
    broadcast and their rows stay where they are. All others meet in a shuffle, to which no key brings more than a
    thousandth of the rows. Where rows of groups have no bounded size, light tells which are small enough for a broadcast;
    hot ones that aren't are shuffled too. groups should be checkpointed, as it is read three times."""
    total = groups.agg(F.sum(size)).first()[0] or 0
    columns = [c for c in groups.columns if c != key]
    is_hot = F.col(size) * HOT_PARTS >= F.lit(total)
    is_hot = is_hot if light is None else is_hot & light
    hot, cold = groups.filter(is_hot), groups.filter(~is_hot)
    hot = hot.select(F.col(key).alias("_hot_key"), *[F.col(c).alias(f"_hot_{c}") for c in columns])
    cold = cold.select(F.col(key).alias("_cold_key"), *[F.col(c).alias(f"_cold_{c}") for c in columns])
    joined = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    # a hot row looks for a nine-byte key that no group has, another one for each row
    nowhere = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(F.xxhash64(*rows.columns)), 16, "0")))
    joined = joined.withColumn("_seek", F.when(F.col("_hot_key").isNull(), F.col(key)).otherwise(nowhere))
    joined = joined.join(cold, F.col("_seek") == F.col("_cold_key"), "left")
    return joined.select(*rows.columns, *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in columns])


#: Folders of the tables that the innermost own_tables() of this thread has seen written.
_OWN: ContextVar[list[str] | None] = ContextVar("own tables", default=None)


@contextmanager
def own_tables() -> Iterator[list[str]]:
    """The folders of what is written() inside, by this thread; those that aren't emptied() go on to an own_tables() around it."""
    around, own = _OWN.get(), []
    token = _OWN.set(own)
    try:
        yield own
    finally:
        _OWN.reset(token)
        if around is not None:
            around += own


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as a Parquet table in the shared folder and read again. It stays until it is emptied()."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if (own := _OWN.get()) is not None:
        own.append(path)
    return spark.read.schema(df.schema).parquet(path)


def emptied(spark: SparkSession, own: list[str], but: DataFrame) -> None:
    """Writes nothing over the tables in own that aren't needed any more, all but those that `but` reads, to free their space."""
    needed = {f.rsplit("/", 2)[-2] for f in but.inputFiles()}
    for path in [p for p in own if p.rsplit("/", 1)[-1] not in needed]:
        spark.range(0).write.mode("overwrite").parquet(path)
        own.remove(path)


def given_back() -> None:
    """Gives the memory that this Python worker has freed back to the system. Workers live on between tasks and stages, and
    what they keep for later counts against the executor meanwhile."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")
