"""Values at given ranks of each group, without sorting a group: counts by cell, then by cells of the cell that holds the rank."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelark.operators.stretches import Keys, same
from framelark.sources.shared import checkpointed

#: Cells that the range between the least and the greatest value left is cut into.
CELLS = 1024
#: Groups of at least one in so many of all rows are hot, so that there are so many hot ones at most.
HOT = 1000


def _joined(rows: DataFrame, state: DataFrame, keys: Keys, total: int) -> DataFrame:
    """rows with the state of their group. Hot groups' states, HOT at most, are broadcast and their rows stay where they are;
    others meet by key, of which none has more than one in HOT of all rows."""
    if not keys:
        return rows.crossJoin(F.broadcast(state))  # one group
    hot = F.col("_n") * HOT >= F.lit(total)
    out = [rows.alias("l").join(side, same(keys, "l", "r")).select("l.*", "r._state") for side in (F.broadcast(state.filter(hot).alias("r")), state.filter(~hot).alias("r"))]
    return out[0].unionByName(out[1])


def selected(df: DataFrame, keys: Keys, value: str, ranks: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """One row for each group: keys, n, and for each name in ranks(n) the value at that 0-based rank among its n sorted values.

    Nulls and NaN are left out; groups without other values give no row; a rank beyond the values gives null. Values are compared in
    double precision. Each round counts the values that are left by cell of their range, keeps the cell that holds the rank
    and goes on with its values, until they are all equal; a cell's least and greatest value bound the next round, so each
    round at least parts those two. All groups and ranks go through the same rounds, of which ordinary numbers need two or three."""
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    wanted = ranks(F.col("_n"))
    each = F.array(*[F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank"), "low", "high") for name, rank in wanted.items()])
    groups = checkpointed(groups.select(*keys, "_n", each.alias("_each")))
    total = groups.agg(F.sum("_n")).first()[0] or 0
    inside = F.filter("_each", lambda s: (s["rank"] >= 0) & (s["rank"] < F.col("_n")))
    state, done = groups.select(*keys, "_n", F.inline(inside)), []
    while True:
        state = checkpointed(state)
        done.append(state.filter("low = high").select(*keys, "name", F.col("low").alias("found")))
        left = state.filter("low < high")
        if left.isEmpty():
            break
        by_group = left.groupBy(*keys, "_n").agg(F.collect_list(F.struct("name", "rank", "low", "high")).alias("_state"))  # a struct for each rank
        part = _joined(rows, by_group, keys, total).select(*keys, "_v", F.explode("_state").alias("_s")).filter("_v BETWEEN _s.low AND _s.high")
        cell = _cell(F.col("_v"), F.col("_s.low"), F.col("_s.high"))
        cells = part.groupBy(*keys, "_s", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_k"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        w = Window.partitionBy(*keys, "_s").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)  # CELLS + 3 rows
        cells = cells.withColumn("_below", F.sum("_k").over(w) - F.col("_k"))
        holds = (F.col("_below") <= F.col("_s.rank")) & (F.col("_s.rank") < F.col("_below") + F.col("_k"))
        kept = cells.filter(holds).select(*keys, F.struct(F.col("_s.name").alias("name"), (F.col("_s.rank") - F.col("_below")).alias("rank"), F.col("_low").alias("low"), F.col("_high").alias("high")).alias("_s"))
        state = kept.alias("l").join(groups.select(*keys, "_n").alias("r"), same(keys, "l", "r")).select(*[F.col(f"l.`{k}`") for k in keys], "r._n", "l._s.*")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    found = found.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == name, F.col("found"))).alias(name) for name in wanted])
    out = groups.alias("l").join(found.alias("r"), same(keys, "l", "r"), "left")
    return out.select(*[F.col(f"l.`{k}`") for k in keys], F.col("l._n").alias("n"), *[F.col(f"r.{name}") for name in wanted])


def _cell(v: Column, low: Column, high: Column) -> Column:
    """Which of CELLS equal parts of low to high v is in; rising with v, 0 for low and CELLS for high. Infinite values are in
    cells of their own; halves are subtracted, as the difference of two finite numbers may be infinite."""
    infinite = F.lit(float("inf"))
    bound = lambda x: F.greatest(F.least(x, F.lit(1.7976931348623157e308)), F.lit(-1.7976931348623157e308))
    span = bound(high) / 2 - bound(low) / 2
    share = F.when(span > 0, (bound(v) / 2 - bound(low) / 2) / span)
    # neighbours that are too near for their halves to differ are parted by comparing
    cell = F.when(v == high, CELLS).when(v == low, 0).otherwise(F.floor(F.coalesce(share, F.lit(0.5)) * CELLS).cast("long"))
    return F.when(v == -infinite, -1).when(v == infinite, CELLS + 1).otherwise(cell).cast("long")


def median(df: DataFrame, keys: Keys, value: str) -> DataFrame:
    """(keys, n, median): the middle value, or the mean of the two in the middle."""
    found = selected(df, keys, value, lambda n: {"_low": F.floor((n - 1) / 2), "_high": F.floor(n / 2)})
    return found.select(*keys, "n", (F.col("_low") / 2 + F.col("_high") / 2).alias("median"))
