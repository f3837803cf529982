"""Spikes of all patients on the axis, each by its patient's clock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.operators import asof

#: Fixed value: a step of the clock longer than so many milliseconds is a pause.
LONGEST_STEP = 200.0
#: Milliseconds of a patient's recording that one task has at a time.
STRETCH = 600_000.0


def spike_times(spikes: DataFrame, watchlog: DataFrame, longest: float = LONGEST_STEP, bucket: float = STRETCH) -> DataFrame:
    """(patient, unit_id, t): spikes (patient, unit_id, t_ms) in seconds of the axis, by the clock (patient, i, pts, neural_ms).

    Those outside the clock, in a pause or without a finite time go."""
    finite = spikes.filter(F.col("t_ms").isNotNull() & ~F.isnan("t_ms") & (F.abs("t_ms") != float("inf")))
    on_axis = asof.interpolated(finite, watchlog, ["patient"], "t_ms", "neural_ms", "pts", "i", longest, bucket)
    return on_axis.filter(~F.isnan("value") & (F.abs("value") != float("inf"))).select("patient", "unit_id", F.col("value").alias("t"))


def spike_trains(units: DataFrame, spikes: DataFrame, watchlog: DataFrame, longest: float = LONGEST_STEP, bucket: float = STRETCH) -> DataFrame:
    """units (patient, unit_id and more) with times, the sorted array of their spike_times(); empty for a unit without any."""
    each = spike_times(spikes, watchlog, longest, bucket).groupBy("patient", "unit_id").agg(F.sort_array(F.collect_list("t")).alias("times"))
    return units.join(each, ["patient", "unit_id"], "left").withColumn("times", F.coalesce("times", F.array().cast("array<double>")))
