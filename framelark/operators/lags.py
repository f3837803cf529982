"""Correlation of points with a regular grid at many lags: blocks of both meet once, whatever the number of lags."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelark.operators.stretches import Keys, same

#: Seconds of a block. It holds the points in it, and of the grid as much and what the lags reach beyond.
BLOCK = 60.0
SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def moments(t: np.ndarray, y: np.ndarray, lags: np.ndarray, first: int, x: np.ndarray, low: int, high: int, step: float, half: float) -> np.ndarray:
    """Sums of 1, x, y, xx, yy and xy (rows) at each lag (columns), with x interpolated at t + lag from samples first, first + 1, ...
    of a grid that goes from low to high; its ends reach on. A sample that is NaN is missing: points that begin at it don't count."""
    out = np.zeros((len(SUMS), len(lags)))
    for i, lag in enumerate(lags):
        place = (t + lag) / step - half
        k = np.clip(np.floor(place), low, high).astype(np.int64)
        x0 = x[k - first]
        x1 = x[np.minimum(k + 1, high) - first]
        share = np.clip(place - k, 0, 1)
        at = x0 + share * (np.where(np.isnan(x1), x0, x1) - x0)
        own = ~np.isnan(at)
        a, b = at[own], y[own]
        out[:, i] = own.sum(), a.sum(), b.sum(), a @ a, b @ b, a @ b
    return out


def lag_sums(points: DataFrame, grid: DataFrame, keys: Keys, by: str, lags: list[float], step: float, half: float = 0.5, block: float = BLOCK) -> DataFrame:
    """(keys, by, lag, SUMS): sums over points (keys, by, t, y) and what a grid (keys, k, x), whose sample k stands at
    (k + half) * step, has at t + lag. Points with nulls, and keys without a grid, have no part in them.

    Points are gathered by blocks of time, the grid by blocks with a margin for all lags; the two meet by keys and block, so
    what is shuffled doesn't depend on the number of lags. A task makes a block's sums for all lags at once."""
    block_of = lambda t: F.floor(t / block).cast("long")
    most, least = max(lags), min(lags)
    here = (F.col("k") + half) * step
    margin = 2 * step
    samples = grid.filter(F.col("k").isNotNull() & F.col("x").isNotNull()).select(*keys, F.col("k").cast("long").alias("k"), F.col("x").cast("double").alias("x"))
    ends = samples.groupBy(*keys).agg(F.min_by(F.struct("k", "x"), "k").alias("_low"), F.max_by(F.struct("k", "x"), "k").alias("_high"))
    blocks = F.explode(F.sequence(block_of(here - most - margin), block_of(here - least + margin)))
    arrays = samples.select(*keys, "k", "x", blocks.alias("_block")).groupBy(*keys, "_block").agg(F.collect_list(F.struct("k", "x")).alias("_grid"))
    each = points.filter(F.col("t").isNotNull() & F.col("y").isNotNull()).select(*keys, by, F.col("t").cast("double").alias("t"), F.col("y").cast("double").alias("y"), block_of(F.col("t")).alias("_block"))
    each = each.groupBy(*keys, by, "_block").agg(F.collect_list(F.struct("t", "y")).alias("_points"))
    columns = [F.col(f"l.`{k}`") for k in keys]
    met = each.alias("l").join(arrays.alias("r"), (F.col("l._block") == F.col("r._block")) & same(keys, "l", "r"), "left").select(*columns, f"l.{by}", "l._points", "r._grid")
    met = met.alias("l").join(ends.alias("r"), same(keys, "l", "r")).select(*columns, f"l.{by}", "l._points", "l._grid", "r._low", "r._high")
    wanted = np.array(lags, np.float64)
    names = [*keys, by]
    schema = T.StructType([*(met.schema[c] for c in names), *T.StructType.fromDDL(", ".join(f"{s} array<double>" for s in SUMS)).fields])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            of = {c: batch.column(batch.schema.get_field_index(c)) for c in ("_points", "_grid", "_low", "_high")}
            made = []
            for i in range(batch.num_rows):
                own, low, high = of["_points"][i].values, of["_low"][i].as_py(), of["_high"][i].as_py()
                samples = of["_grid"][i].values
                k = np.concatenate([[low["k"], high["k"]], samples.field("k").to_numpy() if samples is not None else []]).astype(np.int64)
                x = np.concatenate([[low["x"], high["x"]], samples.field("x").to_numpy() if samples is not None else []])
                made.append(_block_sums(own.field("t").to_numpy(), own.field("y").to_numpy(), wanted, k, x, low["k"], high["k"], step, half))
            sums = [pa.array([m[j].tolist() for m in made], pa.list_(pa.float64())) for j in range(len(SUMS))]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), *sums], schema.names)

    sums = met.mapInArrow(summed, schema)
    zipped = F.arrays_zip(F.array(*map(F.lit, lags)).alias("lag"), *SUMS)
    rows = sums.select(*names, F.inline(zipped))
    return rows.groupBy(*names, "lag").agg(*[F.sum(s).alias(s) for s in SUMS])


def _block_sums(t: np.ndarray, y: np.ndarray, lags: np.ndarray, k: np.ndarray, x: np.ndarray, low: int, high: int, step: float, half: float) -> np.ndarray:
    """moments() from samples k, x in any order: those near the points, and the grid's ends, which may be far from them."""
    reach = np.array([(t.min() + lags.min()) / step - half - 2, (t.max() + lags.max()) / step - half + 3])
    first, last = np.clip(np.floor(reach), low, high).astype(np.int64)
    dense = np.full(last - first + 1, np.nan)
    near = (k >= first) & (k <= last)
    dense[k[near] - first] = x[near]
    # what is held here reaches to an end of the grid or beyond all points
    return moments(t, y, lags, int(first), dense, int(first), int(last), step, half)


def lag_correlation(points: DataFrame, grid: DataFrame, keys: Keys, by: str, lags: list[float], step: float, half: float = 0.5, block: float = BLOCK) -> DataFrame:
    """(keys, by, lag, r): Pearson correlation from lag_sums(); null where x or y doesn't vary by more than rounding."""
    s = lag_sums(points, grid, keys, by, lags, step, half, block)
    n, sx, sy, sxx, syy, sxy = (F.col(c) for c in SUMS)
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    return s.select(*keys, by, "lag", F.when((vx > 1e-12 * n * sxx) & (vy > 1e-12 * n * syy), (n * sxy - sx * sy) / F.sqrt(vx) / F.sqrt(vy)).alias("r"))
