"""The tracks of a project, from its canonical tables and what was built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.functions.axis import FRAME_SECONDS, Mapping, seconds
from framelark.operators import runs
from framelark.plans import tracks
from framelark.plans.spikes import spike_times


def _spans(df: DataFrame) -> DataFrame:
    return df.select("label", F.col("first").alias("order"), seconds(F.col("first")).alias("a"), seconds(F.col("last_excl")).alias("b"))


def annotation_track(annotations: DataFrame, groups: dict[str, list[str]] | None = None, rest: str = "Locations") -> DataFrame:
    """Intervals of all labels (label, p, v). groups names labels that belong together; those in none are in group `rest`."""
    spans = runs.intervals(annotations, ["label"], "p", runs.is_on(F.col("v")))
    every = annotations.select("label").distinct()
    if groups:
        grouped = {label for labels in groups.values() for label in labels}
        groups = groups | {rest: sorted(r["label"] for r in every.filter(~F.col("label").isin(*grouped)).collect())}  # labels are few
    return tracks.intervals(_spans(every.join(spans, "label", "left")), "annotations", "Annotations", "Labels", groups, "Frame-wise labels as intervals")


def cue_track(cues: DataFrame, language: str) -> DataFrame:
    """Timed text (start, end, text) that is on the axis."""
    rows = cues.select(F.col("start").alias("a"), F.col("end").alias("b"), "text")
    return tracks.text(rows, f"subs_{language}", f"Subtitles {language.upper()}", "Text", "Subtitles on the axis")


def frame_change_track(signal: DataFrame, n_frames: int) -> DataFrame:
    """The signal (i, mad) of a recording that lies on the axis; an error if it has another number of frames."""
    n = signal.count()
    if n != n_frames:
        raise ValueError(f"{n} frames instead of {n_frames}")
    return tracks.series(signal.select("i", F.col("mad").alias("v")), "frame_change", "Frame change", 0.0, FRAME_SECONDS, "Stimulus", "mean absolute difference", "Difference to the frame before")


def spike_track(units: DataFrame, spikes: DataFrame, watchlog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The track of all units, and (patient, data) the binaries it points into."""
    times = spike_times(spikes, watchlog)
    named = units.select("patient", "unit_id", F.col("brain_region").alias("region"), "hemisphere", F.col("is_single_unit").alias("single_unit"), "cell_type")
    return tracks.spikes(named, times, "spikes", "Spikes", "Brain", "Spikes on the axis, without those in pauses"), tracks.spike_binary(times)


def alignment_track(frame_map: DataFrame, mapping: Mapping) -> DataFrame:
    """Where a frame map (p, flag) is less certain, where it has no picture, and the break."""
    names = F.when(F.col("flag") == 1, "maybe one frame off").when(F.col("flag") == 2, "no picture")
    flagged = runs.intervals(frame_map.withColumn("label", names), ["label"], "p", F.col("flag") > 0)
    brk = frame_map.sparkSession.range(1).select(F.lit("break").alias("label"), F.lit(mapping.brk).cast("long").alias("first"), F.lit(mapping.brk + 1).cast("long").alias("last_excl"))
    every = frame_map.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, ("maybe one frame off", "no picture", "break")))).alias("label"))
    return tracks.intervals(_spans(every.join(flagged.unionByName(brk), "label", "left")), "alignment", "Alignment quality", "Alignment")
