"""A stream of points put on a static clock, as each micro-batch arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.operators.asof import with_next


def interpolated_stream(points: DataFrame, clock: DataFrame, keys: list[str], at: str, clock_at: str, clock_value: str, tie: str, longest: float, bucket: float) -> DataFrame:
    """As asof.interpolated, for a streaming points DataFrame: without windows over the stream, so no state is kept.

    The clock's steps are copied to each bucket of time they touch; a point meets those of its bucket by equality."""
    steps = with_next(clock.select(*keys, clock_at, clock_value, tie), keys, clock_at, tie)
    k0, k1, v0, v1 = (F.col(f"_{c}") for c in ("k0", "k1", "v0", "v1"))
    steps = steps.select(*keys, F.col(clock_at).alias("_k0"), F.col(f"next_{clock_at}").alias("_k1"), F.col(clock_value).alias("_v0"), F.col(f"next_{clock_value}").alias("_v1"))
    last = steps.groupBy(*keys).agg(F.max("_k1").alias("_end"))
    steps = steps.filter(k1.isNotNull() & (k1 - k0 <= longest) & (v0 != v1) & (k1 > k0)).join(last, keys)
    steps = steps.withColumn("_b", F.explode(F.sequence(F.floor(k0 / bucket).cast("long"), F.floor(k1 / bucket).cast("long"))))
    joined = points.withColumn("_b", F.floor(F.col(at) / bucket).cast("long")).join(steps, [*keys, "_b"])
    inside = (F.col(at) >= k0) & ((F.col(at) < k1) | ((F.col(at) == k1) & (k1 == F.col("_end"))))
    return joined.filter(inside).withColumn("value", v0 + (F.col(at) - k0) * (v1 - v0) / (k1 - k0)).drop("_b", "_k0", "_k1", "_v0", "_v1", "_end")
