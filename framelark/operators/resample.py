"""Resampling of signals that come in chunks of any length, by a windowed sinc, exact to the sample.

Output blocks are dealt to tasks; each gets the source samples it needs, its own and a margin of the kernel's reach on both
sides, so what comes out doesn't depend on how the source was cut or the work was dealt."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelark.operators.stretches import Keys, same

#: Zero crossings of the kernel on each side; output samples of a block; source samples of a cell.
CROSSINGS, BLOCK, CELL = 32, 1 << 16, 1 << 16


def reach(step: float, crossings: int = CROSSINGS) -> int:
    """Source samples on each side that a kernel for this step takes: more where the output is coarser than the source."""
    return int(np.ceil(crossings * max(step, 1.0)))


def kernel(distance: np.ndarray, step: float, crossings: int = CROSSINGS) -> np.ndarray:
    """Weights at distances in source samples: a sinc that cuts off at the lower of both rates' half, under a Blackman window."""
    cutoff = min(1.0, 1.0 / step)
    width = crossings / cutoff
    share = np.clip(np.abs(distance) / width, 0, 1)
    window = 0.42 + 0.5 * np.cos(np.pi * share) + 0.08 * np.cos(2 * np.pi * share)
    return np.where(np.abs(distance) < width, cutoff * np.sinc(cutoff * distance) * window, 0.0)


def resampled_block(x: np.ndarray, first: int, start: float, step: float, n: np.ndarray, crossings: int = CROSSINGS) -> np.ndarray:
    """Output samples n (whole numbers): sample n stands at start + n * step among source samples first, first + 1, ... of x;
    beyond these all is 0."""
    half = reach(step, crossings)
    out = np.zeros(len(n))
    padded = np.concatenate([np.zeros(2 * half + 2), x, np.zeros(2 * half + 2)])
    taps = np.arange(-half, half + 1)
    for at in range(0, len(n), 4096):  # some at a time: a row of taps for each
        place = start + n[at : at + 4096] * step
        middle = np.floor(place).astype(np.int64)
        index = np.clip(middle[:, None] + taps - first + 2 * half + 2, 0, len(padded) - 1)
        out[at : at + 4096] = (padded[index] * kernel(place[:, None] - middle[:, None] - taps, step, crossings)).sum(1)
    return out


def resampled(samples: DataFrame, plan: DataFrame, keys: Keys, crossings: int = CROSSINGS, block: int = BLOCK, cell: int = CELL) -> DataFrame:
    """(keys, segment, first_sample, y): output chunks of at most `block` samples, which are all of the plan.

    samples (keys, start, x) are chunks of a source, start the number of x's first sample; chunks may be of any lengths, in any
    order, and lack parts, which are 0. plan (keys, segment, first_sample, n_samples, start, step): output samples
    first_sample, first_sample + 1, ... n_samples of them; the k-th stands at source sample start + k * step. What lies before
    a segment's start isn't heard in it: after a gap that was cut nothing of the gap sounds on. Where the source ends
    early the rest is silence. Segments with nulls, of steps that aren't positive, or without samples, give nothing."""
    good = plan.filter((F.col("n_samples") > 0) & F.col("first_sample").isNotNull() & F.col("start").isNotNull() & (F.col("step") > 0))
    rows = good.select(*keys, "segment", F.col("first_sample").cast("long").alias("first_sample"), F.col("n_samples").cast("long").alias("n_samples"), F.col("start").cast("double").alias("_start"), F.col("step").cast("double").alias("_step"))
    rows = rows.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_samples") - 1) / block).cast("long"))))
    half = F.ceil(crossings * F.greatest(F.col("_step"), F.lit(1.0)))
    low = F.greatest(F.floor(F.col("_start") + F.col("_b") * block * F.col("_step")) - half, F.ceil("_start")).cast("long")
    last = F.least((F.col("_b") + 1) * block, F.col("n_samples")) - 1
    high = (F.ceil(F.col("_start") + last * F.col("_step")) + half).cast("long")
    rows = rows.withColumns({"_low": low, "_high": high})
    cells = rows.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_low") / cell).cast("long"), F.floor(F.greatest("_high", "_low") / cell).cast("long"))))

    # each chunk's part of each cell it touches
    chunks = samples.filter(F.size("x") > 0).select(*keys, F.col("start").cast("long").alias("_s"), F.col("x").cast("array<double>").alias("_x"))
    chunks = chunks.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_s") / cell).cast("long"), F.floor((F.col("_s") + F.size("_x") - 1) / cell).cast("long"))))
    begin = F.greatest(F.col("_cell") * cell - F.col("_s"), F.lit(0))
    end = F.least((F.col("_cell") + 1) * cell - F.col("_s"), F.size("_x").cast("long"))
    chunks = chunks.select(*keys, "_cell", (F.col("_s") + begin).alias("_s"), F.slice("_x", (begin + 1).cast("int"), (end - begin).cast("int")).alias("_x"))

    names = [*keys, "segment", "first_sample", "n_samples", "_start", "_step", "_b", "_low", "_high"]
    met = cells.alias("l").join(chunks.alias("r"), (F.col("l._cell") == F.col("r._cell")) & same(keys, "l", "r"), "left").select(*[F.col(f"l.`{c}`") for c in names], F.when(F.col("r._s").isNotNull(), F.struct("r._s", "r._x")).alias("_chunk"))
    # a block, its margins and what their cells hold
    blocks = met.groupBy(*names).agg(F.collect_list("_chunk").alias("_chunks"))
    schema = T.StructType([*(rows.schema[c] for c in (*keys, "segment")), *T.StructType.fromDDL("first_sample long, y array<double>").fields])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                first, n, start, step, b, low, high = (column[c][i].as_py() for c in names[len(keys) + 1 :])
                x = np.zeros(max(high - low + 1, 0))
                for chunk in column["_chunks"][i]:
                    at, values = chunk["_s"].as_py(), np.nan_to_num(chunk["_x"].values.to_numpy(zero_copy_only=False))
                    a, z = max(at, low), min(at + len(values), high + 1)
                    if a < z:
                        x[a - low : z - low] = values[a - at : z - at]
                y = resampled_block(x, low, start, step, np.arange(b * block, min((b + 1) * block, n)), crossings)
                out = [batch.column(j).slice(i, 1) for j in range(len(keys) + 1)]
                yield pa.RecordBatch.from_arrays([*out, pa.array([first + b * block], pa.int64()), pa.array([y], pa.list_(pa.float64()))], schema.names)

    return blocks.mapInArrow(made, schema)
