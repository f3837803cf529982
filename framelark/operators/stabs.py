"""How many spans hold a point, and the least of them, without a row for each pair."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelark.operators.runs import cells_of
from framelark.operators.stretches import Keys, numbered, stretch
from framelark.sources.shared import checkpointed

#: Points and ends of spans in a stretch.
ROWS = 1 << 16


def held_by(lo: np.ndarray, hi: np.ndarray, n: np.ndarray, rank: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place 0 to size - 1, the sum of n over the ranges lo <= place < hi, and the least rank of these, len(rank) if there is none."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, lo, n)
    np.subtract.at(steps, hi, n)
    least = np.full(size, len(rank), np.int64)
    # two ranges of a power-of-two length cover each; ranges of one length hand down to their halves
    level = np.log2(hi - lo).astype(np.int64)
    for k in range(level.max(initial=0), -1, -1):
        own = level == k
        np.minimum.at(least, lo[own], rank[own])
        np.minimum.at(least, hi[own] - (1 << k), rank[own])
        if k:
            half = 1 << (k - 1)
            least = np.concatenate([least[:half], np.minimum(least[half:], least[:-half])])
    return steps.cumsum()[:-1], least


def stab_counts(points: DataFrame, spans: DataFrame, keys: Keys, at: str, first: str, last_excl: str, value: str, rows: int = ROWS) -> DataFrame:
    """points that a span of their keys holds (first <= at < last_excl), with `n`, how many do, and `least`, the least value of these.

    Points and both ends of spans are numbered together, by key and place on the axis, and dealt by stretches of `rows` of them. A span goes to
    the stretches in which it starts and ends. For those between, spans are cut into cells of power-of-two numbers of
    stretches and counted by cell, so a stretch gets one row for all spans that cover it. A stretch so has no more ranges than rows, plus
    one, however many spans hold its points. Rows without a place or a key are left out."""
    cut = spans.filter(F.col(first) < F.col(last_excl)).withColumn("_id", F.monotonically_increasing_id())  # before ends are made of it, which share it
    cut = cut.select(*keys, "_id", F.col(value).alias("_v"), F.explode(F.array(F.col(first), F.col(last_excl))).alias("_at"), F.lit(0).alias("_side"))
    present = F.lit(True)
    for k in keys:
        present = present & F.col(f"`{k}`").isNotNull()
    # ends come before points at the same place, so that first counts and last_excl doesn't
    marks = cut.unionByName(points.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.struct(*points.columns).alias("_point")), allowMissingColumns=True)
    marks = numbered(marks.filter(F.col("_at").isNotNull() & present), keys, ["_at", "_side"], "_i")

    both = marks.filter("_side = 0").groupBy(*keys, "_id").agg(F.min("_i").alias("_lo"), F.max("_i").alias("_hi"), F.first("_v").alias("_v"))
    both = checkpointed(both.select(*keys, "_lo", "_hi", "_v", stretch(F.col("_lo"), rows).alias("_a"), stretch(F.col("_hi"), rows).alias("_b")))
    low, high = F.col("_stretch") * rows, (F.col("_stretch") + 1) * rows
    ends = both.withColumn("_stretch", F.explode(F.array_distinct(F.array("_a", "_b"))))
    pieces = ends.select(*keys, "_stretch", F.greatest("_lo", low).alias("_lo"), F.least("_hi", high).alias("_hi"), F.lit(1).cast("long").alias("_n"), "_v")

    longest = both.agg(F.max(F.col("_b") - F.col("_a") - 1)).first()[0]  # stretches between
    levels = range(max(longest or 0, 0).bit_length())

    def at_level(k: int) -> Column:
        return F.transform(cells_of(F.col("_a") + 1, F.col("_b") - 1, k), lambda c: F.struct(F.lit(1 << k).cast("long").alias("_size"), c.alias("_cell")))

    if levels:
        cells = both.filter("_b - _a > 1").select(*keys, "_v", F.inline(F.flatten(F.array(*map(at_level, levels))))).groupBy(*keys, "_size", "_cell").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_v"))
        # cells of one length don't overlap, so each stretch gets a row of each length at most
        inside = cells.withColumn("_stretch", F.explode(F.sequence(F.expr("_cell * _size"), F.expr("(_cell + 1) * _size - 1"))))
        inside = inside.groupBy(*keys, "_stretch").agg(F.sum("_n").alias("_n"), F.min("_v").alias("_v"))
        pieces = pieces.unionByName(inside.select(*keys, "_stretch", low.alias("_lo"), high.alias("_hi"), "_n", "_v"))
    pieces = pieces.filter("_lo < _hi")

    placed = marks.filter("_side = 1").select(*keys, stretch(F.col("_i"), rows).alias("_stretch"), "_i", "_point")
    schema = T.StructType([*points.schema.fields, T.StructField("n", T.LongType()), T.StructField("least", spans.schema[value].dataType)])

    def counted(group: pa.Table) -> pa.Table:
        is_point = group["_i"].is_valid()
        own, ranges = group.filter(is_point), group.filter(pc.invert(is_point))
        start = group["_stretch"][0].as_py() * rows
        lo, hi, n = ranges["_lo"].to_numpy() - start, ranges["_hi"].to_numpy() - start, ranges["_n"].to_numpy()
        values = ranges["_v"].combine_chunks()
        order = pc.sort_indices(values).to_numpy()  # nulls last
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        count, least = held_by(lo, hi, n, rank, rows)
        i = own["_i"].to_numpy() - start
        held = count[i] > 0
        i, own = i[held], own.filter(pa.array(held))
        found = own["_point"].combine_chunks().flatten()
        return pa.Table.from_arrays([*found, pa.array(count[i], pa.int64()), values.take(pa.array(order[least[i]]))], schema.names)

    return placed.unionByName(pieces, allowMissingColumns=True).groupBy(*keys, "_stretch").applyInArrow(counted, schema)
