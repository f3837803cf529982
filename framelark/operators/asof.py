"""As-of and nearest joins of points with a clock, by entity, without range joins.

Rows of both sides meet by entity and, if `bucket` is given, by a stretch of the time axis, so that an entity with a large
share of all rows is dealt to many tasks. What a stretch needs from its neighbours is one row before and one after it,
which come from a table with one row for each entity and stretch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

Keys = list[str]


def _bucket(at: str, bucket: float | None) -> Column:
    return F.floor(F.col(at) / bucket).cast("long") if bucket else F.lit(0).cast("long")


def _firsts(rows: DataFrame, keys: Keys) -> DataFrame:
    return rows.groupBy(*keys, "_b").agg(F.min("_row").alias("_first"), F.max("_row").alias("_last"))


def with_next(clock: DataFrame, keys: Keys, at: str, tie: str, bucket: float | None = None) -> DataFrame:
    """clock with next_<c> for each other column c, from the row that follows by (at, tie); null on the last row of an entity."""
    rest = [c for c in clock.columns if c not in keys]
    rows = clock.withColumn("_b", _bucket(at, bucket)).withColumn("_row", F.struct(at, tie, *[c for c in rest if c not in (at, tie)]))
    w = Window.partitionBy(*keys, "_b").orderBy(at, tie)
    later = _firsts(rows, keys).withColumn("_later", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_b")))
    rows = rows.withColumn("_next", F.lead("_row").over(w)).join(later.select(*keys, "_b", "_later"), [*keys, "_b"], "left")
    rows = rows.withColumn("_next", F.coalesce("_next", "_later"))
    return rows.select(*clock.columns, *[F.col(f"_next.{c}").alias(f"next_{c}") for c in rest])


def _together(points: DataFrame, clock: DataFrame, keys: Keys, at: str, clock_at: str, tie: str, bucket: float | None) -> tuple[DataFrame, Keys, WindowSpec]:
    """Rows of both sides in one table, what they are dealt by, and the window that has them in order within it: clock rows have _row,
    points _point. With stretches, each row also has _earlier, the last clock row of those before, and _here and _later, the first
    clock rows of its own and of those behind."""
    rest = [c for c in clock.columns if c not in keys]
    row = F.struct(clock_at, tie, *[c for c in rest if c not in (clock_at, tie)])
    c = clock.select(*keys, F.col(clock_at).cast("double").alias("_at"), F.lit(0).alias("_side"), F.col(tie).cast("long").alias("_tie"), _bucket(clock_at, bucket).alias("_b"), row.alias("_row"))
    p = points.select(*keys, F.col(at).cast("double").alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_tie"), _bucket(at, bucket).alias("_b"), F.struct(*[x for x in points.columns if x not in keys]).alias("_point"))
    both = c.unionByName(p, allowMissingColumns=True)
    if bucket:
        borders = both.groupBy(*keys, "_b").agg(F.min("_row").alias("_here"), F.max("_row").alias("_last"))
        w = Window.partitionBy(*keys).orderBy("_b")
        borders = borders.select(
            *keys, "_b", F.last("_last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"), "_here", _next_known("_here", keys, ["_b"]).alias("_later")
        )
        both = both.join(borders, [*keys, "_b"], "left")
    else:
        nothing = F.lit(None).cast(c.schema["_row"].dataType)
        both = both.select("*", *[nothing.alias(x) for x in ("_earlier", "_here", "_later")])
    by = [*keys, "_b"] if bucket else [*keys]
    return both, by, Window.partitionBy(*by).orderBy(*_ORDER)


_ORDER = ["_at", "_side", "_tie"]


def _next_known(column: str, keys: Keys, order: list[str]) -> Column:
    """The next value that isn't null. A frame that reaches to the end would cost the square of its rows."""
    by = ", ".join(f"`{k}`" for k in keys)
    return F.expr(f"lead({column}) IGNORE NULLS OVER ({'PARTITION BY ' + by if by else ''} ORDER BY {', '.join(order)})")


def around(points: DataFrame, clock: DataFrame, keys: Keys, at: str, clock_at: str, tie: str, bucket: float | None = None) -> DataFrame:
    """points with `before` and `after`: structs of the clock's columns from the last row at or before the point, and from the
    row that follows that one (the first row of all if there is none before). Of rows at one time the last by tie counts as before."""
    both, by, w = _together(points, clock, keys, at, clock_at, tie, bucket)
    before = F.last("_row", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_before", before).withColumn("_after", _next_known("_row", by, _ORDER)).filter("_side = 1")
    return found.select(*_points(points, keys), F.coalesce("_before", "_earlier").alias("before"), F.coalesce("_after", "_later").alias("after"))


def _points(points: DataFrame, keys: Keys) -> list[Column]:
    return [F.col(f"`{n}`").cast(points.schema[n].dataType).alias(n) if n in keys else F.col(f"_point.`{n}`").alias(n) for n in points.columns]


def interpolated(
    points: DataFrame, clock: DataFrame, keys: Keys, at: str, clock_at: str, clock_value: str, tie: str, longest: float, bucket: float | None = None
) -> DataFrame:
    """points that lie on the clock, with its linearly interpolated value in column value.

    A point belongs to the step that starts at the last clock row at or before it; the last step also holds its end. Points
    outside the clock go, and those in a pause: a step longer than `longest`, or one over which the value stands still."""
    both, by, w = _together(points, clock.select(*keys, clock_at, clock_value, tie), keys, at, clock_at, tie, bucket)
    both = both.withColumn("_next", F.coalesce(_next_known("_row", by, _ORDER), "_later"))
    step = F.struct(F.col("_row").alias("a"), F.col("_next").alias("b"))
    step = F.when(F.col("_row").isNotNull() & F.col("_next").isNotNull(), step)
    both = both.withColumn("_step", F.last(step, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("_side = 1")
    # a point before the first row of its stretch is in the step that leads there
    a, b = F.coalesce("_step.a", "_earlier"), F.coalesce("_step.b", F.coalesce("_here", "_later"))
    found = both.select(*_points(points, keys), a[clock_at].alias("_k0"), b[clock_at].alias("_k1"), a[clock_value].alias("_v0"), b[clock_value].alias("_v1"))
    k0, k1, v0, v1 = (F.col(c) for c in ("_k0", "_k1", "_v0", "_v1"))
    found = found.filter((k0 <= F.col(at)) & (F.col(at) <= k1) & (k1 - k0 <= longest) & (v1 != v0) & (k1 > k0))
    return found.withColumn("value", v0 + (F.col(at) - k0) * (v1 - v0) / (k1 - k0)).drop("_k0", "_k1", "_v0", "_v1")


def nearest(points: DataFrame, clock: DataFrame, keys: Keys, at: str, clock_at: str, tie: str, bucket: float | None = None) -> DataFrame:
    """points with the clock row that is nearest in time, in struct `near`; of two equally near the earlier."""
    found = around(points, clock, keys, at, clock_at, tie, bucket)
    back, forth = F.col(at) - F.col(f"before.{clock_at}"), F.col(f"after.{clock_at}") - F.col(at)
    near = F.when(back.isNull() | (forth < back), F.col("after")).otherwise(F.col("before"))
    return found.withColumn("near", near).drop("before", "after")


def within(points: DataFrame, clock: DataFrame, keys: Keys, at: str, clock_at: str, tie: str, tolerance: float, bucket: float | None = None) -> DataFrame:
    """points that have a clock row within tolerance; their columns only."""
    found = nearest(points, clock, keys, at, clock_at, tie, bucket)
    return found.filter(F.abs(F.col(f"near.{clock_at}") - F.col(at)) <= tolerance).drop("near")


def edge_shift(points: DataFrame, edges: DataFrame, keys: Keys, at: str, edge_at: str, tie: str, bucket: float | None = None) -> DataFrame:
    """points with `shift`, the signed time to the nearest edge; of two equally near the earlier."""
    return nearest(points, edges, keys, at, edge_at, tie, bucket).withColumn("shift", F.col(f"near.{edge_at}") - F.col(at)).drop("near")


def grid_value(points: DataFrame, grid: DataFrame, t: Column, step: float, half: float = 0.5, keys: Keys = ()) -> DataFrame:
    """points with `x`, interpolated at time t from a regular grid (keys, k, x) whose sample k stands at (k + half) * step.

    The grid's ends, of whatever k, reach on unchanged; a point at a missing sample, or of a key without a grid, has no x. As the grid
    is regular there is nothing to search: one join on k, with the next sample beside. Each key's first and last k come
    from a table with one row for each key."""
    keys = list(keys)
    w = Window.partitionBy(*keys, F.floor(F.col("_k") / 4096)).orderBy("_k")
    own = grid.select(*keys, F.col("k").cast("long").alias("_k"), F.col("x").alias("_x0"))
    # the next sample, from the same stretch or, for its last one, from the first of the next
    border = own.filter(F.col("_k") % 4096 == 0).select(*keys, (F.col("_k") - 1).alias("_k"), F.col("_x0").alias("_x2"))
    own = own.withColumn("_x1", F.when(F.lead("_k").over(w) == F.col("_k") + 1, F.lead("_x0").over(w)))
    own = own.join(border, [*keys, "_k"], "left").withColumn("_x1", F.coalesce("_x1", "_x2")).drop("_x2")
    ends = own.groupBy(*keys).agg(F.min("_k").alias("_start"), F.max("_k").alias("_end"))
    rows = points.join(ends, keys, "left") if keys else points.crossJoin(F.broadcast(ends))  # one row without keys
    place = t / step - half
    rows = rows.withColumn("_k", F.least(F.greatest(F.floor(place), F.col("_start")), F.col("_end")).cast("long")).drop("_start", "_end").join(own, [*keys, "_k"], "left")
    share = F.least(F.greatest(place - F.col("_k"), F.lit(0.0)), F.lit(1.0))
    return rows.withColumn("x", F.col("_x0") + share * (F.coalesce("_x1", "_x0") - F.col("_x0"))).drop("_k", "_x0", "_x1")
