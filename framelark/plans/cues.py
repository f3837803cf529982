"""Moving timed text to the axis and writing it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.functions.axis import DURATION, FRAME_SECONDS, Mapping
from framelark.functions.text import time_code


def retimed(cues: DataFrame, mapping: Mapping, start: str = "start", end: str = "end") -> DataFrame:
    """cues with start and end on the axis. A cue whose start has no place there goes. One that ends in the removed section,
    beyond the axis or behind the break ends at the break if it starts before it, else with the axis."""
    brk = F.lit(mapping.brk * FRAME_SECONDS) if not isinstance(mapping.brk, Column) else mapping.brk * FRAME_SECONDS
    a, b = mapping.to_axis(F.col(start)), mapping.to_axis(F.col(end))
    rows = cues.withColumn("_a", a).withColumn("_b", b).filter(F.col("_a").isNotNull())
    before = F.col("_a") < brk
    clipped = F.when(before, F.least(brk, F.lit(DURATION))).otherwise(F.lit(DURATION))
    over_end = F.col("_b").isNull() | (before & (brk <= F.col("_b")))
    return rows.withColumn(start, F.col("_a")).withColumn(end, F.when(over_end, clipped).otherwise(F.col("_b"))).drop("_a", "_b")


def as_text(cues: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key: srt, vtt and json of its cues in the given order. A file is one string, so its cues meet in a row."""
    listed = cues.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, "start", "end", "text"))).alias("cues"))
    line = lambda c, s: F.concat(time_code(c["start"], s), F.lit(" --> "), time_code(c["end"], s), F.lit("\n"), c["text"], F.lit("\n"))
    srt = F.array_join(F.transform("cues", lambda c, i: F.concat((i + 1).cast("string"), F.lit("\n"), line(c, ","))), "\n")
    vtt = F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform("cues", lambda c: line(c, ".")), "\n"))
    json = F.to_json(F.transform("cues", lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["text"].alias("text"))))
    return listed.select(*keys, srt.alias("srt"), vtt.alias("vtt"), json.alias("json"))
