"""Ordered rows dealt to many tasks by stretches of their order, so that no entity has to fit into one.

numbered() gives rows their place among those of their keys. What works on an index without gaps, such as that place or a
frame number, then needs only rows near each other (by_stretches), or one row for each stretch (running, runs.intervals)."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelark.sources.shared import checkpointed

Keys = list[str]
#: Rows of a stretch. A window group has so many and what it needs of its neighbours.
SIZE = 100_000


def stretch(index: Column, size: int) -> Column:
    return F.floor(index / size).cast("long")


def same(keys: Keys, left: str, right: str) -> Column:
    """Whether rows of two aliases have equal keys; nulls equal one another."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`"))
    return out


def _beside(rows: DataFrame, small: DataFrame, keys: Keys, part: str, columns: list[str]) -> DataFrame:
    """rows with columns of small, which has a row for each of their keys and parts."""
    on = (F.col(f"l.{part}") == F.col(f"r.{part}")) & same(keys, "l", "r")
    return rows.alias("l").join(small.alias("r"), on).select("l.*", *[F.col(f"r.{c}") for c in columns])


def numbered(df: DataFrame, keys: Keys, order: str | list[str], name: str = "n", total: str | None = None, parts: int | None = None) -> DataFrame:
    """df with a row's number (from 0) among the rows of its keys by `order`, and, if asked for, how many there are.

    Rows are dealt by ranges of keys and order and sorted there; so a task knows each row's number within it. What the
    tasks before hold is counted by key and task: a row for each key, and one more for each border inside a key. order has
    to be unique within keys, or equal rows are numbered as they come; nulls come first. Without keys the counts, one for
    each task, are summed by the driver."""
    columns = [F.col(c) for c in [*keys, *([order] if isinstance(order, str) else order)]]
    dealt = df.repartitionByRange(parts, *columns) if parts else df.repartitionByRange(*columns)
    # kept, as ranges are drawn from a sample: counted again they might lie elsewhere
    rows = checkpointed(dealt.sortWithinPartitions(*columns).withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    counts = rows.groupBy(*keys, "_part").agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias("_n"))
    if keys:
        w = Window.partitionBy(*keys)
        before = F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
        starts = counts.withColumn("_before", before).withColumn("_total", F.sum("_n").over(w))
    else:
        found = sorted((r["_part"], r["_start"], r["_n"]) for r in counts.collect())
        before = [0, *accumulate(n for _, _, n in found)]
        made = [(part, start, b, before[-1]) for (part, start, _), b in zip(found, before, strict=False)]
        starts = F.broadcast(df.sparkSession.createDataFrame(made, "_part long, _start long, _before long, _total long"))  # a row for each task
    out = _beside(rows, starts, keys, "_part", ["_start", "_before", "_total"])
    out = out.withColumn(name, F.col("_at") - F.col("_start") + F.col("_before"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], name, *([F.col("_total").alias(total)] if total else []))


def by_stretches(df: DataFrame, keys: Keys, index: str, before: int, after: int, apply: Callable[[DataFrame, Keys], DataFrame], size: int = SIZE) -> DataFrame:
    """apply(df, keys), where apply looks at most `before` rows back and `after` rows on in the order of index.

    apply is called with a stretch among the keys and rows of the neighbours copied across its borders; its results for
    these are dropped. index numbers the rows of each key without gaps. apply keeps index, and each row or drops it."""
    i = F.col(index)
    wide = df.withColumn("_stretch", F.explode(F.sequence(stretch(i - after, size), stretch(i + before, size))))
    return apply(wide, [*keys, "_stretch"]).filter(F.col("_stretch") == stretch(i, size)).drop("_stretch")


def running(df: DataFrame, keys: Keys, index: str, value: str, name: str, size: int = SIZE) -> DataFrame:
    """df with the sum of value over the rows of the same keys up to this one, by index. Nulls count as 0.

    Sums within stretches, and before each what the stretches before it add up to; those are a row for each stretch."""
    rows = df.withColumn("_stretch", stretch(F.col(index), size)).withColumn("_v", F.coalesce(F.col(value), F.lit(0)))
    sums = rows.groupBy(*keys, "_stretch").agg(F.sum("_v").alias("_sum"))
    w = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("_before", F.sum("_sum").over(w) - F.col("_sum"))
    here = F.sum("_v").over(Window.partitionBy(*keys, "_stretch").orderBy(index).rowsBetween(Window.unboundedPreceding, 0))
    out = _beside(rows, sums, keys, "_stretch", ["_before"])
    return out.withColumn(name, here + F.col("_before")).drop("_stretch", "_v", "_before")


def merged(local: DataFrame, keys: Keys, size: int, value: str | None = None) -> DataFrame:
    """Runs (keys, first, last_excl, n and value, if it is given) that were found in each stretch by itself, with those joined
    that go on across borders. Only runs that touch a border, two a stretch at most, are put in order by key."""
    rest = [value] if value else []
    local = checkpointed(local.select(*keys, *rest, "first", "last_excl", "n"))
    touches = (F.pmod("first", F.lit(size)) == 0) | (F.pmod("last_excl", F.lit(size)) == 0)
    w = Window.partitionBy(*keys).orderBy("first")
    goes_on = F.coalesce(F.lag("last_excl").over(w) == F.col("first"), F.lit(False))
    if value:
        goes_on = goes_on & F.lag(value).over(w).eqNullSafe(F.col(value))
    at_borders = local.filter(touches).withColumn("_new", (~goes_on).cast("long"))
    at_borders = at_borders.withColumn("_run", F.sum("_new").over(w))
    joined = at_borders.groupBy(*keys, "_run", *rest).agg(F.min("first").alias("first"), F.max("last_excl").alias("last_excl"), F.sum("n").alias("n"))
    return local.filter(~touches).unionByName(joined.drop("_run"))
