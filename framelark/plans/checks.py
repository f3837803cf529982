"""Checking a mapping against the recording, with controls that have to fail."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.functions.axis import ANALYSIS_FIRST, ANALYSIS_LAST, FRAME_SECONDS, RATE, Mapping, axis, seconds
from framelark.operators import asof, lags, runs, signal
from framelark.plans.fit import KEY, SECONDS, for_each, keyed, mappings, of_columns, stretch_of
from framelark.sources.shared import checkpointed

#: Shares of cuts that have to be, or may be at most, exact; speech edges may be off by so many seconds.
LEAST_EXACT, MOST_EXACT_OF_CONTROL, MOST_SHIFT = 0.80, 0.10, 0.15
VAD_STEP = 0.01


def cut_offsets(frames: DataFrame, at: DataFrame, reach: int = 5) -> DataFrame:
    """at (recording, t and more) with `offset`: where around the frame nearest to t the recording changes most."""
    return _offsets_at(_loudest(frames, reach), at)


def _loudest(frames: DataFrame, reach: int = 5) -> DataFrame:
    """(recording, i, pts, offset) of all frames, kept."""
    frames = keyed(frames).select(KEY, F.col("i").cast("long").alias("i"), "pts", F.col("mad").cast("double").alias("mad"))
    return checkpointed(signal.loudest(frames, [KEY], "i", "mad", reach).select(KEY, "i", "pts", "offset"))


def _offsets_at(frames: DataFrame, at: DataFrame) -> DataFrame:
    bucket = stretch_of(frames)
    at = checkpointed(keyed(at)) if bucket else keyed(at)  # stretches are asked for their borders first
    near = asof.nearest(at, frames, [KEY], "t", "pts", "i", bucket).filter("near IS NOT NULL")
    return near.select(*[c for c in near.columns if c != "near"], F.col("near.offset").alias("offset"))


def variants() -> Column:
    """Array of (variant, MAPPING) from a row's mapping: itself, its head one frame off to both sides, and without the gap if it has one."""
    gap = F.col("gap")
    struct = lambda name, head, gap: F.struct(F.lit(name).alias("variant"), "film_fps", (F.col("head") + head).alias("head"), "brk", gap.alias("gap"), "t0")
    all_ = F.array(struct("mapping", 0, gap), struct("head_minus_1", -1, gap), struct("head_plus_1", 1, gap), struct("no_gap", 0, gap * 0))
    return F.filter(all_, lambda v: (v["variant"] != "no_gap") | (F.col("gap") != 0))


def cut_stats(mapping: Mapping | DataFrame, frames: DataFrame, onsets: DataFrame, titles: DataFrame, seed: int = 0) -> DataFrame:
    """(recording, variant, segment, n, exact, within_1): how many annotated cuts the mapped recording cuts on, by segment A or B,
    for the mapping and its controls; for titles; and for as many random frames as there are cuts (segments titles and random).
    mapping may be a table as of fits(). All variants run in one job, in which a cut meets its recording's mapping once."""
    frames = _loudest(frames)
    ends = frames.groupBy(KEY).agg(F.max("pts").alias("end"))
    own = checkpointed(mappings(mapping, ends).join(ends, KEY))  # used for cuts and for titles
    place = lambda rows: rows.select(*[c for c in (KEY, "p") if c in rows.columns])
    cuts = for_each(own, place(onsets)).filter(of_columns().source_time(F.col("p")) < F.col("end")).withColumn("p", F.col("p").cast("long"))
    one = lambda variant, segment, m, p: F.struct(variant.alias("variant"), segment.alias("segment"), m.source_time(p).alias("t"))
    segment = F.when(F.col("p") < F.col("brk"), "A").otherwise("B")
    each = F.transform(variants(), lambda v: one(v["variant"], segment, Mapping(*[v[c] for c in _MAPPED]), F.col("p")))
    # the same frame may be drawn twice, and counts twice
    drawn = F.pmod(F.xxhash64("p", F.lit(seed)), F.lit(ANALYSIS_LAST - ANALYSIS_FIRST)) + ANALYSIS_FIRST
    drawn = one(F.lit("mapping"), F.lit("random"), of_columns(), drawn)
    rows = cuts.select(KEY, F.inline(F.concat(each, F.array(drawn))))
    named = for_each(own, place(titles)).select(KEY, F.inline(F.array(one(F.lit("mapping"), F.lit("titles"), of_columns(), F.col("p").cast("long")))))
    o = F.col("offset")
    return _offsets_at(frames, rows.unionByName(named)).groupBy(KEY, "variant", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.avg((o == 0).cast("double")).alias("exact"), F.avg((F.abs(o) <= 1).cast("double")).alias("within_1")
    )


_MAPPED = ["film_fps", "head", "brk", "gap", "t0"]


def cut_verdicts(stats: DataFrame) -> DataFrame:
    """(recording, passes, empty) from cut_stats(): the mapping has to be good and the shifted heads bad in every segment that has
    cuts; empty tells that none has."""
    counted = F.col("segment").isin("A", "B")
    main, shifted = counted & (F.col("variant") == "mapping"), counted & F.col("variant").startswith("head_")
    good, bad = F.bool_and(F.when(main, F.col("exact") >= LEAST_EXACT)), F.bool_and(F.when(shifted, F.col("exact") <= MOST_EXACT_OF_CONTROL))
    return stats.groupBy(KEY).agg((F.coalesce(good, F.lit(True)) & F.coalesce(bad, F.lit(True))).alias("passes"), (F.count_if(main) == 0).alias("empty"))


def check_cuts(mapping: Mapping, frames: DataFrame, onsets: DataFrame, titles: DataFrame, seed: int = 0) -> dict:
    """cut_stats() of one recording as a dictionary by variant and segment, with pass and empty."""
    stats = cut_stats(mapping, frames, onsets, titles, seed).persist()
    names = ["mapping", "head_minus_1", "head_plus_1", *(["no_gap"] if mapping.gap else [])]
    out: dict = {name: {} for name in names}
    for r in stats.collect():  # a row for each variant and segment
        kept = {"n": r["n"], "exact": r["exact"], "within_1": r["within_1"]}
        if r["segment"] in ("titles", "random"):
            out[r["segment"]] = kept
        else:
            out[r["variant"]][r["segment"]] = kept
    verdict = cut_verdicts(stats).first()
    stats.unpersist()
    return out | {"empty": verdict["empty"] if verdict else True, "pass": verdict["passes"] if verdict else True}


LAGS = [round(-1.5 + 0.02 * i, 2) for i in range(151)]


def wrong_speed(mapping: Mapping) -> Mapping:
    """The same mapping at another film rate, with the same start. Fields may be columns."""
    fps = mapping.film_fps
    other = F.when(fps == RATE, 24000 / 1001).otherwise(float(RATE))
    return replace(mapping, film_fps=other, t0=mapping.t0 + mapping.head * (1 / fps - 1 / other))


def lag_scan(mapping: Mapping | DataFrame, vad: DataFrame, speaking: DataFrame, first: int = ANALYSIS_FIRST, last: int = ANALYSIS_LAST, at: list[float] = LAGS) -> DataFrame:
    """lags.lag_correlation() of detected speech (recording, k, v every 10 ms), smoothed, and annotated speech (p, y), for the mapping and
    one with the wrong speed."""
    vad = keyed(vad).select(KEY, F.col("k").cast("long").alias("k"), F.col("v").cast("double").alias("v"))
    grid = runs.smoothed(vad, [KEY], "k", "v", "x").select(KEY, "k", "x")
    p = axis(vad.sparkSession, last + 1).filter(F.col("p") >= first)
    p = p.join(speaking.select("p", F.col("y").cast("double").alias("y")), "p", "left").select("p", F.coalesce("y", F.lit(0.0)).alias("y"))
    own, middle = of_columns(), (F.col("p") + 0.5) * FRAME_SECONDS
    both = F.inline(F.array(*[F.struct(F.lit(name).alias("variant"), m.to_source(middle).alias("t")) for name, m in (("mapping", own), ("wrong_speed", wrong_speed(own)))]))
    return lags.lag_correlation(mappings(mapping, vad).crossJoin(p).select(KEY, "y", both), grid, [KEY], "variant", at, VAD_STEP)


def speech_edges(vad: DataFrame) -> DataFrame:
    """(recording, side, k, e): starts and ends of detected speech, in seconds; gaps and runs too short for speech are filled and dropped."""
    on = keyed(vad).select(KEY, F.col("k").cast("long").alias("k"), (F.col("v") > 0).alias("s"))
    on = runs.opened(runs.closed(on, [KEY], "k", "s", 15), [KEY], "k", "s", 10)
    starts = runs.rising(on, [KEY], "k", F.col("s")).select(KEY, F.lit("first").alias("side"), "k", (F.col("k") * VAD_STEP).alias("e"))
    return starts.unionByName(runs.falling(on, [KEY], "k", F.col("s")).select(KEY, F.lit("last_excl").alias("side"), "k", ((F.col("k") + 1) * VAD_STEP).alias("e")))


def speech_shifts(mapping: Mapping | DataFrame, vad: DataFrame, spans: DataFrame) -> DataFrame:
    """(recording, side, shift): the median time from annotated starts and ends of speech, intervals (first, last_excl), to detected
    ones less than a second away."""
    vad = keyed(vad)
    side = F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("p")) for s in ("first", "last_excl")]))
    at = for_each(mappings(mapping, vad), spans).select(KEY, side, *_MAPPED).select(KEY, "side", of_columns().to_source(seconds(F.col("p"))).alias("t"))
    found = asof.edge_shift(at, speech_edges(vad), [KEY, "side"], "t", "e", "k", SECONDS).filter(F.abs("shift") < 1)
    return found.groupBy(KEY, "side").agg(F.median("shift").alias("shift"))


def check_audio(mapping: Mapping, vad: DataFrame, speaking: DataFrame, spans: DataFrame, first: int = ANALYSIS_FIRST, last: int = ANALYSIS_LAST) -> dict:
    """Detected speech against annotated speech, for one recording: lag_scan() and speech_shifts().

    Correlation at no lag has to be three times the best one of a mapping with the wrong speed, and annotated ends of
    speech have to be near detected ones."""
    r = lag_scan(mapping, vad, speaking, first, last).persist()  # 302 rows
    best = {v["variant"]: v for v in signal.best(r, ["variant"], "r", "lag").collect()}
    zero = r.filter("variant = 'mapping' AND lag = 0").first()["r"]
    r.unpersist()
    shift = {x["side"]: x["shift"] for x in speech_shifts(mapping, vad, spans).collect()}
    out = {"r_at_zero_lag": zero, "best_lag": best["mapping"]["lag"], "r_best": best["mapping"]["r"], "r_wrong_speed": best["wrong_speed"]["r"],
           "onset_shift": shift.get("first"), "offset_shift": shift.get("last_excl")}
    good = zero is not None and zero > 3 * max(out["r_wrong_speed"], 0.01) and out["offset_shift"] is not None and abs(out["offset_shift"]) <= MOST_SHIFT
    return out | {"pass": bool(good)}
