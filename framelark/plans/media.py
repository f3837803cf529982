"""What encoders have to do, as tables: which source frame every output frame shows, how many samples each stretch of sound
has, and in which order packets go into a file. The encoding itself is for an adapter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelark.functions.axis import N_FRAMES, RATE, Mapping
from framelark.operators import ordered, resample
from framelark.plans.fit import KEY, MAPPING, of_columns


def picture_plan(frame_map: DataFrame) -> DataFrame:
    """(recording, p, file_frame, action) from a frame map: black beyond the end; repeat if the frame before shows the same; else show."""
    w = Window.partitionBy("recording").orderBy("p")
    action = F.when(F.col("flag") == 2, "black").when(F.col("file_frame") == F.lag("file_frame").over(w), "repeat").otherwise("show")
    return frame_map.select("recording", "p", "file_frame", action.alias("action"))


def dropped_frames(frames: DataFrame, plan: DataFrame) -> DataFrame:
    """Source frames that no output frame shows."""
    return frames.join(plan.select(F.col("file_frame").alias("i")).distinct(), "i", "left_anti")


def sound_plans(mappings: DataFrame, rate: int = 48_000) -> DataFrame:
    """(recording, segment, first_sample, n_samples, from_time, speed) for each of mappings (recording, MAPPING): output samples of each
    stretch, exact to the sample, and where in the source it starts. Stretches without frames are left out."""
    cut = F.least(F.col("brk"), F.lit(N_FRAMES)).cast("long")
    stretch = lambda k, p0, p1: F.struct(F.lit(k).alias("segment"), p0.alias("p0"), p1.alias("p1"))
    both = F.inline(F.array(stretch(0, F.lit(0).cast("long"), cut), stretch(1, cut, F.lit(N_FRAMES).cast("long"))))
    samples = lambda p: F.floor(p * rate / RATE).cast("long")
    rows = mappings.select(KEY, *MAPPING, both).filter("p1 > p0")
    return rows.select(KEY, "segment", samples(F.col("p0")).alias("first_sample"), (samples(F.col("p1")) - samples(F.col("p0"))).alias("n_samples"),
                       of_columns().source_time(F.col("p0")).alias("from_time"), (RATE / F.col("film_fps")).alias("speed"))


def sound_plan(spark: SparkSession, mapping: Mapping, rate: int = 48_000) -> DataFrame:
    """sound_plans() of one mapping."""
    one = spark.range(1).select(F.lit(0).alias(KEY), F.inline(F.array(mapping.struct())))
    return sound_plans(one, rate).drop(KEY)


def mono(samples: DataFrame) -> DataFrame:
    """(n, x): the mean over channels of (channel, n, x)."""
    return samples.groupBy("n").agg(F.avg("x").alias("x"))


def mux_plan(packets: DataFrame, size: str = "size", keys: list[str] = ()) -> DataFrame:
    """Packets (keys, stream, seq, dts, and more) with where each goes: place, by decode time, at one time the lower stream first and
    within it the lower seq; and offset, the bytes before it. Packets without a decode time are in no file. keys: of files."""
    return ordered.laid_out(packets.filter(F.col("dts").isNotNull()), list(keys), ["dts", "stream", "seq"], size)


def sheet_frames(candidates: DataFrame, n: int, first: int, last: int, seed: int = 0) -> DataFrame:
    """n frames strictly between first and last, the same ones for a seed whatever the partitioning. A limit is the feature."""
    inside = candidates.filter((F.col("p") > first) & (F.col("p") < last)).select("p").distinct()
    return inside.orderBy(F.xxhash64("p", F.lit(seed)), "p").limit(n).orderBy("p")


def report_html(title: str, rows: list[dict]) -> str:
    """A small table of verification results."""
    from html import escape

    names = list(rows[0]) if rows else []
    head = "".join(f"<th>{escape(str(n))}</th>" for n in names)
    body = "".join("<tr>" + "".join(f"<td>{escape(str(r[n]))}</td>" for n in names) + "</tr>" for r in rows)
    return f"<!DOCTYPE html><title>{escape(title)}</title><h1>{escape(title)}</h1><table><tr>{head}</tr>{body}</table>"


def retimed_sound(samples: DataFrame, mappings: DataFrame, source_rate: float, rate: int = 48_000, keys: list[str] = ()) -> DataFrame:
    """(recording, keys, segment, first_sample, y): sound (recording, keys, start, x) of source_rate on the axis, at rate samples
    a second, by sound_plans(). keys: what parts a recording's sound beside, such as channels."""
    plans = sound_plans(mappings, rate)
    step = F.col("speed") * source_rate / rate
    plan = plans.select(KEY, "segment", "first_sample", "n_samples", F.rint(F.col("from_time") * source_rate).alias("start"), step.alias("step"))
    if keys:
        plan = samples.select(KEY, *keys).distinct().join(plan, KEY)
    return resample.resampled(samples, plan, [KEY, *keys])
