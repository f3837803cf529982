"""Finding the mappings of recordings: film rate, head, gap and break, from cuts seen in each and cuts annotated on the axis.

Everything is keyed by recording, so any number of recordings is fitted by the same few jobs, and dealt by stretches of each
recording's time beside. What is carried from job to job are tables of cuts, far smaller than the signals; they are checkpointed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelark.functions.axis import N_FRAMES, Mapping, axis
from framelark.operators import asof, peaks, runs, signal, stretches
from framelark.sources.shared import checkpointed

#: Film rates that are tried, the earlier wins ties.
FILM_RATES = [25.0, 24000 / 1001, 24.0]
#: Rows of one recording's signal share a key, so that windows are bounded by recordings.
KEY = "recording"
#: Stretches of frames, and of seconds, by which nearest frames are sought.
FRAMES, SECONDS = 15_000.0, 600.0
SEGMENTS = "array<struct<middle:double,offset:bigint,rest:double,matched:bigint,first:double,last:double>>"
MAPPING = ["film_fps", "head", "brk", "gap", "t0"]


def keyed(df: DataFrame) -> DataFrame:
    """df with a column recording; where it has none all rows are of recording 0."""
    return df if KEY in df.columns else df.withColumn(KEY, F.lit(0))


def of_columns() -> Mapping:
    """The mapping that a table's columns hold."""
    return Mapping(*[F.col(c) for c in MAPPING])


def mappings(mapping: Mapping | DataFrame, like: DataFrame) -> DataFrame:
    """(recording, MAPPING), one row for each: a table as of fits(), or one mapping for all recordings of `like`."""
    if isinstance(mapping, DataFrame):
        return keyed(mapping).select(KEY, *MAPPING)
    return like.select(KEY).distinct().select(KEY, F.inline(F.array(mapping.struct())))


def for_each(recordings: DataFrame, rows: DataFrame) -> DataFrame:
    """rows for each of recordings: those that carry it, or all of them if rows are of the axis and so of every recording."""
    return recordings.join(rows, KEY) if KEY in rows.columns else recordings.crossJoin(rows)


def stretch_of(frames: DataFrame) -> float | None:
    """Seconds by which nearest frames are sought: those that FRAMES frames take in the densest recording that has more, on average.
    Where none has more there is nothing to deal further than by recording: None."""
    n, length = F.count("pts"), F.max("pts") - F.min("pts")
    step = frames.groupBy(KEY).agg(n.alias("n"), length.alias("length")).filter(F.col("n") > FRAMES).agg(F.min(F.col("length") / F.col("n"))).first()[0]
    return None if step is None else FRAMES * step if 0 < step < float("inf") else SECONDS


def rate_scan(seen: DataFrame, cuts: DataFrame, rates: list[float] = FILM_RATES) -> DataFrame:
    """(recording, rank, rate, peaks): offsets between seen cuts (recording, i, pts) at each rate and annotated ones (recording, p)."""
    table = F.array(*[F.struct(F.lit(k).alias("rank"), F.lit(float(r)).alias("rate")) for k, r in enumerate(rates)])
    moved = seen.select(KEY, "pts", F.inline(table)).withColumn("x", F.col("pts") * F.col("rate"))
    histogram = peaks.offsets(moved, cuts.select(KEY, "p", F.inline(table)).drop("rate"), [KEY, "rank"], "x", "p")
    names = F.create_map(*[v for k, r in enumerate(rates) for v in (F.lit(k), F.lit(float(r)))])
    return peaks.peaks_by(histogram, [KEY, "rank"]).withColumn("rate", names[F.col("rank")])


def fits(frames: DataFrame, onsets: DataFrame, others: DataFrame) -> DataFrame:
    """One row for each recording: its MAPPING, what it was found by, and error, null if it was found.

    frames (recording, i, pts, mad) are the recordings' signals, onsets (p) annotated cuts, others (p) more frames at which
    scenes change. Both may have recording too; else they count for each. Without that column there is one recording, 0."""
    frames = keyed(frames).select(KEY, "i", "pts", F.col("mad").cast("double").alias("mad"))
    seen = signal.cuts(frames, [KEY], "i", "mad").select(KEY, "i", "pts")
    seen, every = checkpointed(seen), checkpointed(frames.select(KEY).distinct())
    cuts = checkpointed(for_each(every, onsets.withColumn("p", F.col("p").cast("double"))).select(KEY, "p").distinct())

    scan = checkpointed(rate_scan(seen, cuts))
    rate = scan.groupBy(KEY).agg(
        F.max_by(F.struct("rate", "peaks"), F.struct(F.col("peaks")[0]["n"], -F.col("rank"))).alias("s"), F.sort_array(F.collect_list(F.struct("rank", "rate", "peaks"))).alias("rates")
    )
    rate = rate.select(KEY, "s.rate", "rates", peaks.significant_in(F.col("s.peaks")).alias("offsets"))

    # cuts that have a seen cut within a frame, by offset
    moved = cuts.join(rate.select(KEY, F.explode("offsets").alias("offset")), KEY).withColumn("x", F.col("p") + F.col("offset"))
    places = seen.join(rate.select(KEY, "rate"), KEY).select(KEY, "i", (F.col("pts") * F.col("rate")).alias("x_seen"))
    near = asof.nearest(moved, places, [KEY], "x", "x_seen", "i", FRAMES).withColumn("rest", F.col("near.x_seen") - F.col("x"))
    matched = checkpointed(near.filter(F.abs("rest") <= 1.0).select(KEY, "offset", "p", "rest"))
    part = matched.groupBy(KEY, "offset").agg(F.median("p").alias("middle"), F.median("rest").alias("rest"), F.count(F.lit(1)).alias("matched"), F.min("p").alias("first"), F.max("p").alias("last"))
    parts = part.groupBy(KEY).agg(F.array_sort(F.collect_list(F.struct("middle", "offset", "rest", "matched", "first", "last"))).alias("segments"))
    parts = checkpointed(parts)
    found = every.join(rate, KEY, "left").join(parts, KEY, "left").withColumn("segments", F.coalesce("segments", F.array().cast(SEGMENTS)))
    one, two = F.get("segments", F.lit(0)), F.get("segments", F.lit(1))
    found = found.withColumn("n", F.size("segments"))

    # agree counts, for a split at p, matches on their own side of it
    pair = found.filter("n = 2").select(KEY, "rate", one["offset"].alias("head"), (two["offset"] - one["offset"]).alias("gap"), (one["rest"] / F.col("rate")).alias("t0"), two["matched"].alias("all_b"), (one["matched"] + two["matched"]).alias("total"))
    both = matched.join(pair.select(KEY, "head", "all_b", "total"), KEY).groupBy(KEY, "p", "all_b", "total").agg(F.count_if(F.col("offset") == F.col("head")).alias("a"), F.count_if(F.col("offset") != F.col("head")).alias("b"))
    before = Window.partitionBy(KEY).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    agree = both.withColumn("agree", so_far("a") + F.col("all_b") - so_far("b"))
    agree = checkpointed(agree)
    split = signal.best(agree, [KEY], "agree", "p").select(KEY, F.col("p").alias("split"), "agree")
    sides = agree.drop("agree").join(split, KEY).groupBy(KEY, "split", (F.col("total") - F.col("agree")).alias("coincidental"), "total").agg(
        (F.max(F.when((F.col("a") > 0) & (F.col("p") < F.col("split")), F.col("p"))) + 1).cast("long").alias("low"),
        (F.min(F.when((F.col("b") > 0) & (F.col("p") >= F.col("split")), F.col("p"))) + 60).cast("long").alias("high"),
    )
    clean = (F.col("coincidental") < 0.05 * F.col("total")) & (F.col("low") < F.col("high"))
    changes = for_each(every, onsets).select(KEY, "p").unionByName(for_each(every, others).select(KEY, "p"))
    sides = checkpointed(sides)
    breaks = best_break(frames, changes, sides.filter(clean).join(pair.drop("total"), KEY))

    out = found.join(sides.select(KEY, "split", "coincidental", "total", clean.alias("clean")), KEY, "left").join(breaks, KEY, "left")
    error = F.when((F.col("n") < 1) | (F.col("n") > 2), F.concat(F.lit("one or two segments are expected, offsets are "), F.to_json(F.transform("segments", lambda s: s["offset"]))))
    error = error.when((F.col("n") == 2) & ~F.coalesce("clean", F.lit(False)), F.lit("no clean split between the two segments"))
    good = error.isNull()
    return out.select(
        KEY, F.when(good, F.col("rate")).alias("film_fps"), F.when(good, one["offset"]).alias("head"), F.when(good, F.coalesce("best", F.lit(N_FRAMES).cast("long"))).alias("brk"),
        F.when(good, F.coalesce(two["offset"] - one["offset"], F.lit(0).cast("long"))).alias("gap"), F.when(good, one["rest"] / F.col("rate")).alias("t0"),
        "rates", "segments", "split", "coincidental", F.col("best_score").alias("break_score"), "tied", error.alias("error"),
    )


def best_break(frames: DataFrame, changes: DataFrame, sides: DataFrame) -> DataFrame:
    """(recording, best, best_score, tied): the break, of low to high - 1, at which annotated changes within 50 frames of that
    range land on the greatest changes of the recording; of equally good ones the last.

    sides has (recording, rate, head, gap, t0, low, high). A change lands in one of two places, as it stands before the break or
    not; so it is looked up twice, and the score of every break is a running sum of what changes bring."""
    near = changes.select(KEY, F.col("p").cast("long").alias("p")).distinct().join(sides, KEY).filter((F.col("p") >= F.col("low") - 50) & (F.col("p") < F.col("high") + 50))
    side = F.explode(F.array(F.lit(0), F.lit(1))).alias("side")
    looked = near.select(KEY, "p", "rate", "head", "gap", "t0", side).withColumn("t", Mapping(F.col("rate"), F.col("head"), F.when(F.col("side") == 1, F.col("p")).otherwise(F.col("p") + 1), F.col("gap"), F.col("t0")).source_time(F.col("p")))
    ranked = signal.rank01(frames, [KEY], "mad", "i").select(KEY, "i", "pts", "score")
    landed = asof.nearest(looked, ranked, [KEY], "t", "pts", "i", SECONDS).groupBy(KEY, "p").pivot("side", [0, 1]).agg(F.first("near.score"))
    brought = landed.select(KEY, F.col("p").alias("at"), F.lit(0).alias("kind"), F.col("0").alias("sa"), F.col("1").alias("sb"))
    # a break at b has changes before b in the first segment; at b itself a change belongs to the second
    tried = sides.select(KEY, F.explode(F.sequence("low", F.col("high") - 1)).alias("at"), F.lit(-1).alias("kind"))
    w = Window.partitionBy(KEY).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    both = brought.unionByName(tried, allowMissingColumns=True)
    change = F.sum(F.coalesce("sa", F.lit(0.0)) - F.coalesce("sb", F.lit(0.0))).over(w)
    scored = both.withColumn("score", F.round(change + F.sum(F.coalesce("sb", F.lit(0.0))).over(Window.partitionBy(KEY)), 9)).filter("kind = -1")
    scored = checkpointed(scored)
    top = scored.groupBy(KEY).agg(F.max("score").alias("best_score"))
    return scored.join(top, KEY).filter("score = best_score").groupBy(KEY, "best_score").agg(F.max("at").alias("best"), F.count(F.lit(1)).alias("tied"))


def fit(frames: DataFrame, onsets: DataFrame, others: DataFrame) -> tuple[Mapping, dict]:
    """The mapping of a single recording and what it was found by; an error if it has none."""
    rows = fits(frames, onsets, others).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("frames of one recording are expected")
    r = rows[0].asDict(recursive=True)
    if r["error"]:
        raise ValueError(r["error"])
    return Mapping(*[r[c] for c in MAPPING]), {k: v for k, v in r.items() if k not in (KEY, *MAPPING)}


def frame_map(mapping: Mapping | DataFrame, frames: DataFrame, n: int = N_FRAMES) -> DataFrame:
    """(recording, p, file_frame, file_time, flag) for each frame of the axis: the nearest frame of the recording; flag 2 beyond its
    end, else 1 within a burst of repeated frames, else 0. mapping may be a table as of fits()."""
    frames = keyed(frames).select(KEY, "i", "pts", F.col("mad").cast("double").alias("mad"))

    def marked(d: DataFrame, k: list[str]) -> DataFrame:
        d = signal.marked_repeats(d, k, "i", "mad")
        return d.withColumn("step", F.lead("pts").over(runs.over(k, "i")) - F.col("pts"))

    burst = checkpointed(stretches.by_stretches(frames, [KEY], "i", 9, 9, marked).select(KEY, "i", "pts", "burst", "step"))
    # steps take few values, which the median counts
    ends = burst.groupBy(KEY).agg((F.max("pts") + F.coalesce(F.median("step"), F.lit(0.0)) / 2).alias("end"))
    burst = burst.drop("step")
    rows = mappings(mapping, ends).join(ends, KEY).crossJoin(axis(frames.sparkSession, n)).select(KEY, "p", "end", of_columns().source_time(F.col("p")).alias("file_time"))
    near = asof.nearest(rows, burst, [KEY], "file_time", "pts", "i", stretch_of(burst))
    flag: Column = F.when(F.col("file_time") > F.col("end"), 2).when(F.col("near.burst"), 1).otherwise(0)
    return near.select(KEY, "p", F.col("near.i").cast("int").alias("file_frame"), "file_time", flag.cast("smallint").alias("flag"))
