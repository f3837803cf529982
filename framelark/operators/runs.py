"""Runs, edges and neighbourhoods of ordered rows, dealt by entity and stretches of the order.

Where an order column is called index it numbers an entity's rows without gaps; columns made from windows are for use inside
stretches.by_stretches()."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from framelark.operators.stretches import SIZE, by_stretches, merged, numbered, stretch

Keys = list[str]


def over(keys: Keys, order: str | list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*([order] if isinstance(order, str) else order))


def is_on(value: Column) -> Column:
    """Only 1 counts as on; other values (such as 99 for undefined) and null are off."""
    return F.coalesce(value == 1, F.lit(False))


def rising(df: DataFrame, keys: Keys, index: str, on: Column, size: int = SIZE) -> DataFrame:
    """Rows that are on after one that isn't, or first."""
    edge = lambda d, k: d.withColumn("_edge", F.col("_on") & ~F.lag("_on", 1, False).over(over(k, index)))
    return by_stretches(df.withColumn("_on", on), keys, index, 1, 0, edge, size).filter("_edge").drop("_on", "_edge")


def falling(df: DataFrame, keys: Keys, index: str, on: Column, size: int = SIZE) -> DataFrame:
    """Rows that are on before one that isn't, or last."""
    edge = lambda d, k: d.withColumn("_edge", F.col("_on") & ~F.lead("_on", 1, False).over(over(k, index)))
    return by_stretches(df.withColumn("_on", on), keys, index, 0, 1, edge, size).filter("_edge").drop("_on", "_edge")


def intervals(df: DataFrame, keys: Keys, p: str, on: Column, size: int = SIZE) -> DataFrame:
    """Half-open intervals (first, last_excl) of consecutive integers p that are on. p may have gaps, which end intervals."""
    rows = df.filter(on).select(*keys, F.col(p).cast("long").alias("_p")).withColumn("_stretch", stretch(F.col("_p"), size))
    rows = rows.withColumn("_island", F.col("_p") - F.row_number().over(over([*keys, "_stretch"], "_p")))
    local = rows.groupBy(*keys, "_stretch", "_island").agg(F.min("_p").alias("first"), (F.max("_p") + 1).alias("last_excl"), F.count(F.lit(1)).alias("n"))
    return merged(local, keys, size).drop("n")


def bands(df: DataFrame, keys: Keys, order: str | list[str], value: str, size: int = SIZE) -> DataFrame:
    """(value, first, last, n) of each run of equal values, by row number from 0; nulls equal one another."""
    rows = numbered(df, keys, order, "_i").withColumn("_stretch", stretch(F.col("_i"), size))
    w = over([*keys, "_stretch"], "_i")
    starts = ~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)
    rows = rows.withColumn("_run", F.sum(starts.cast("long")).over(w))
    local = rows.groupBy(*keys, "_stretch", "_run", value).agg(F.min("_i").alias("first"), (F.max("_i") + 1).alias("last_excl"), F.count(F.lit(1)).alias("n"))
    return merged(local, keys, size, value).select(*keys, value, "first", (F.col("last_excl") - 1).alias("last"), "n")


def dilated(flag: Column, keys: Keys, order: str, before: int, after: int) -> Column:
    """Whether any row from before rows back to after rows on is flagged."""
    return F.coalesce(F.max(flag.cast("int")).over(over(keys, order).rowsBetween(-before, after)), F.lit(0)) == 1


def eroded(flag: Column, keys: Keys, order: str, before: int, after: int) -> Column:
    """Whether all of them are; rows that aren't there count as unflagged."""
    return F.coalesce(F.sum(flag.cast("int")).over(over(keys, order).rowsBetween(-before, after)), F.lit(0)) == before + after + 1


def spread(df: DataFrame, keys: Keys, index: str, flag: str, name: str, before: int, after: int, size: int = SIZE) -> DataFrame:
    """df with dilated() of a flag."""
    return by_stretches(df, keys, index, before, after, lambda d, k: d.withColumn(name, dilated(F.col(flag), k, index, before, after)), size)


def closed(df: DataFrame, keys: Keys, index: str, flag: str, size: int, rows: int = SIZE) -> DataFrame:
    """Gaps shorter than size are filled. The window of an even size reaches one further back for erosion, forth for dilation.
    rows: of a stretch."""
    low, high = size // 2, size - 1 - size // 2

    def both(d: DataFrame, k: Keys) -> DataFrame:
        d = d.withColumn(flag, dilated(F.col(flag), k, index, high, low))
        return d.withColumn(flag, eroded(F.col(flag), k, index, low, high))

    return by_stretches(df, keys, index, low + high, low + high, both, rows)


def opened(df: DataFrame, keys: Keys, index: str, flag: str, size: int, rows: int = SIZE) -> DataFrame:
    """Runs shorter than size are dropped. rows: of a stretch."""
    low, high = size // 2, size - 1 - size // 2

    def both(d: DataFrame, k: Keys) -> DataFrame:
        d = d.withColumn(flag, eroded(F.col(flag), k, index, low, high))
        return d.withColumn(flag, dilated(F.col(flag), k, index, high, low))

    return by_stretches(df, keys, index, low + high, low + high, both, rows)


def smoothed(df: DataFrame, keys: Keys, index: str, x: str, name: str, size: int = SIZE) -> DataFrame:
    """df with smoothed5() of x."""
    return by_stretches(df, keys, index, 2, 2, lambda d, k: d.withColumn(name, smoothed5(x, k, index)), size)


def smoothed5(x: str, keys: Keys, order: str) -> Column:
    """Mean of five rows around each; beyond the ends rows repeat in mirror order, the end row first."""
    w = over(keys, order)
    here = F.col(x)
    back, forth = F.lag(x).over(w), F.lead(x).over(w)
    back2 = F.coalesce(F.lag(x, 2).over(w), F.when(back.isNull(), F.coalesce(forth, here)).otherwise(back))
    forth2 = F.coalesce(F.lead(x, 2).over(w), F.when(forth.isNull(), F.coalesce(back, here)).otherwise(forth))
    return (back2 + F.coalesce(back, here) + here + F.coalesce(forth, here) + forth2) / 5


#: Halvings of the axis, at most: a span's cells are of lengths 1 to 2^LEVELS.
LEVELS = 62


def cells_of(first: Column, last: Column, level: int) -> Column:
    """Array of those cells of length 2^level, by number, that the integers first to last, both included, are cut into: none,
    one at the left end, one at the right end, or both. Over all levels cells don't overlap and cover exactly the span."""
    a, b = -F.shiftright(-first, level), F.shiftright(last + 1, level)  # whole cells of this level from a to b
    left, right = (a < b) & (F.pmod(a, F.lit(2)) == 1), (a < b) & (F.pmod(b, F.lit(2)) == 1)
    return F.filter(F.array(F.when(left, a), F.when(right, b - 1)), lambda c: c.isNotNull())


def stabbed(points: DataFrame, spans: DataFrame, keys: Keys, at: str, first: str, last_excl: str, unit: float = 1) -> DataFrame:
    """points joined with the spans that hold them, first <= at < last_excl.

    A span is cut into cells of power-of-two lengths, in units of the axis, of each length two at most: a span as long as the whole
    axis is copied 2 log n times. A point looks for the cell of each length that some span has, so the join is an equality
    join by keys, length and cell; what lengths there are, LEVELS at most, is asked first. Near its ends a cell may reach a
    unit further than its span, so both are compared once more."""
    place = lambda c: F.floor(F.col(c) / unit).cast("long")
    cut = spans.filter(F.col(first) < F.col(last_excl)).withColumns({"_a": place(first), "_b": place(last_excl)})
    # an end on a border leaves the cell behind it out
    cut = cut.withColumn("_b", F.when((F.col("_b") * unit >= F.col(last_excl)) & (F.col("_b") > F.col("_a")), F.col("_b") - 1).otherwise(F.col("_b")))
    # no cell is longer than its span, and log2 is rounded up
    longest = cut.agg(F.max(F.col("_b") - F.col("_a") + 1)).first()[0]
    levels = range(min(int(longest).bit_length(), LEVELS) if longest else 0)

    def at_level(k: int) -> Column:
        return F.transform(cells_of(F.col("_a"), F.col("_b"), k), lambda c: F.struct(F.lit(k).alias("_level"), c.alias("_cell")))

    each = F.flatten(F.array(*map(at_level, levels))) if levels else F.array().cast("array<struct<_level:int,_cell:bigint>>")
    cut = cut.select(*spans.columns, F.inline(each))
    used = sorted(r[0] for r in cut.select("_level").distinct().collect())  # LEVELS rows at most
    probes = F.array(*[F.struct(F.lit(k).alias("_level"), F.shiftright(place(at), k).alias("_cell")) for k in used] or [F.struct(F.lit(-1).alias("_level"), F.lit(0).cast("long").alias("_cell"))])
    joined = points.select("*", F.inline(probes)).join(cut, [*keys, "_level", "_cell"])
    return joined.filter((F.col(first) <= F.col(at)) & (F.col(at) < F.col(last_excl))).drop("_level", "_cell")


def either(flags: list[DataFrame], keys: Keys, p: str, flag: str) -> DataFrame:
    """(keys, p, flag, n): by place, whether any of several tables is on there, and how many are. A place that a table lacks is off."""
    rows = None
    for one in flags:
        one = one.select(*keys, p, is_on(F.col(flag).cast("int")).alias("_on"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy(*keys, p).agg(F.bool_or("_on").alias(flag), F.count_if("_on").alias("n"))
