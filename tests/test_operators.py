import random

import pytest
from pyspark.sql import functions as F

from framelark.operators import asof, peaks, runs, signal


def test_recording_vectors(spark):
    """Onsets, intervals and spikes on a clock with a pause of ten seconds."""
    cuts = spark.range(60).select(F.lit("cuts").alias("label"), F.col("id").alias("p"), F.when(F.col("id").isin(28, 43), 1).otherwise(0).alias("v"))
    assert [r["p"] for r in runs.rising(cuts, ["label"], "p", runs.is_on(F.col("v"))).orderBy("p").collect()] == [28, 43]
    p = F.col("id")
    who = spark.range(300).select(F.lit("x").alias("label"), p.alias("p"), F.when((p >= 100) & (p < 200), 1).when((p >= 200) & (p < 250), 99).otherwise(0).alias("v"))
    assert [tuple(r) for r in runs.intervals(who, ["label"], "p", runs.is_on(F.col("v"))).collect()] == [("x", 100, 200)]
    clock = spark.createDataFrame([(1, i, (i + 1) * 0.04, 40.0 * i + (10_000 if i >= 50 else 0)) for i in range(100)], "patient int, i long, pts double, ms double")
    spikes = spark.createDataFrame([(1, 1, t) for t in (0.0, 20.0, 1000.0)] + [(1, 2, t) for t in (5000.0, 12000.0, 13000.0, 99999.0)], "patient int, unit long, t double")
    for bucket in (None, 500.0, 100_000.0):
        got = asof.interpolated(spikes, clock, ["patient"], "t", "ms", "pts", "i", 200.0, bucket)
        rows = {u: sorted(r["value"] for r in got.collect() if r["unit"] == u) for u in (1, 2)}
        assert rows[1] == pytest.approx([0.04, 0.06, 1.04]) and rows[2] == pytest.approx([2.04, 3.04])


def test_interpolation_at_edges(spark):
    clock = spark.createDataFrame([(1, i, 0.04 * i, ms) for i, ms in enumerate((0.0, 40.0, 80.0, 5000.0, 5040.0))] + [(1, 5, 0.16, 5080.0)], "k int, i long, pts double, ms double")
    points = spark.createDataFrame([(1, t) for t in (-1.0, 0.0, 40.0, 80.0, 5000.0, 5040.0, 5080.0, 5081.0)], "k int, t double")
    got = sorted(r["t"] for r in asof.interpolated(points, clock, ["k"], "t", "ms", "pts", "i", 200.0).collect())
    assert got == [0.0, 40.0, 5000.0]  # 80: its step is the pause; from 5040 on the value stands still
    empty = points.filter("t > 1e9")
    assert asof.interpolated(empty, clock, ["k"], "t", "ms", "pts", "i", 200.0).count() == 0
    assert asof.interpolated(points, clock.filter("k = 2"), ["k"], "t", "ms", "pts", "i", 200.0).count() == 0


@pytest.mark.parametrize("bucket", [None, 7.0])
def test_nearest_matches_search(spark, bucket):
    rng = random.Random(2)
    clock = [(k, i, float(rng.randrange(60))) for k in (1, 2) for i in range(15)]
    points = [(rng.randrange(1, 4), j, float(rng.randrange(-5, 70))) for j in range(80)]
    got = asof.nearest(spark.createDataFrame(points, "k int, j long, t double"), spark.createDataFrame(clock, "k int, i long, c double"), ["k"], "t", "c", "i", bucket)
    for r in got.collect():
        own = [c for k, _, c in clock if k == r["k"]]
        want = min(own, key=lambda c: (abs(c - r["t"]), c)) if own else None
        assert (r["near"]["c"] if r["near"] else None) == want
    assert got.count() == 80


def test_grid_is_clamped(spark):
    grid = spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 2.0)], "k long, x double")
    points = spark.createDataFrame([(t,) for t in (-1.0, 0.005, 0.010, 0.0125, 0.025, 9.0)], "t double")
    got = {r["t"]: r["x"] for r in asof.grid_value(points, grid, F.col("t"), 0.01).collect()}
    assert [got[t] for t in (-1.0, 0.005, 0.010, 0.0125, 0.025, 9.0)] == pytest.approx([1, 1, 2, 2.5, 2, 2])


def test_morphology_and_smoothing(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.random(60) < 0.5
    df = spark.createDataFrame([(0, i, bool(v), float(i * i % 7)) for i, v in enumerate(x)], "k int, i long, f boolean, v double")

    def dilate(a, low, high):
        return np.array([a[max(0, i - low) : i + high + 1].any() for i in range(len(a))])

    def erode(a, low, high):
        return np.array([i >= low and i + high < len(a) and a[i - low : i + high + 1].all() for i in range(len(a))])

    want = erode(dilate(x, 2, 2), 2, 2)
    got = [r["f"] for r in runs.closed(df, ["k"], "i", "f", 5).orderBy("i").collect()]
    assert got == want.tolist()
    want = dilate(erode(x, 2, 1), 1, 2)
    assert [r["f"] for r in runs.opened(df, ["k"], "i", "f", 4).orderBy("i").collect()] == want.tolist()
    v = np.array([i * i % 7 for i in range(60)], float)
    padded = np.concatenate([v[1::-1], v, v[:-3:-1]])
    smooth = np.convolve(padded, np.ones(5) / 5, "valid")
    assert [r["s"] for r in df.select("i", runs.smoothed5("v", ["k"], "i").alias("s")).orderBy("i").collect()] == pytest.approx(smooth.tolist())


def test_ties_and_percentiles(spark):
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate((1, 5, 2, 5, 0))], "k int, i long, v int")
    assert signal.best(df, ["k"], "v", "i").first()["i"] == 1
    assert signal.best(df, ["k"], "v", "i", last=True).first()["i"] == 3
    four = spark.createDataFrame([(0, float(v)) for v in (8, 4, 1, 2)], "k int, v double")
    assert tuple(signal.floor_percentile(four, ["k"], "v").first()) == (0, 0.0, 4.0)
    zero = spark.createDataFrame([(0, 0.0), (0, float("nan"))], "k int, v double")
    assert tuple(signal.floor_percentile(zero, ["k"], "v").first()) == (0, 0.0, 1.0)


def test_peaks(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    a, b = sorted(rng.integers(0, 400, 60).tolist()), sorted(rng.integers(0, 400, 40).tolist())
    frame = lambda v, c: spark.createDataFrame([(0, float(x)) for x in v], f"k int, {c} double")
    h = peaks.offsets(frame(a, "x"), frame(b, "y"), ["k"], "x", "y", -100, 150)
    got = {r["offset"]: r["n"] for r in h.collect()}
    want = {}
    for x in a:
        for y in b:
            if -100 <= x - y < 150:
                want[x - y] = want.get(x - y, 0) + 1
    assert got == want
    dense = np.zeros(250)
    for o, n in want.items():
        dense[o + 100] = n
    expected = []
    for _ in range(4):
        j = int(dense.argmax())
        expected.append((j - 100, int(dense[j])))
        dense[max(0, j - 50) : j + 50] = -1
    assert peaks.peaks(h)[:2] == expected[:2]
    assert peaks.significant([(5, 200), (9, 100), (50, 10), (90, 8)]) == [5, 9]
    assert {r["offset"]: r["n"] for r in peaks.dense(h, -100, 150).collect()}[-100] == want.get(-100, 0)


def test_signal_of_pixels(spark):
    df = spark.createDataFrame([(0, 0, [0, 250]), (0, 1, [255, 0]), (0, 2, [255, 10])], "k int, i long, px array<short>")
    assert [r["mad"] for r in signal.frame_signal(df, ["k"], "i", "px").orderBy("i").collect()] == pytest.approx([0.0, 252.5, 5.0])


def test_stab_is_half_open(spark):
    spans = spark.createDataFrame([(1, "a", 0, 10), (1, "b", 5, 25), (1, "none", 7, 7)], "k int, label string, a long, b long")
    points = spark.createDataFrame([(1, p) for p in (0, 5, 9, 10, 24, 25)], "k int, p long")
    got = runs.stabbed(points, spans, ["k"], "p", "a", "b", 8).groupBy("p").agg(F.array_sort(F.collect_list("label")).alias("l"))
    assert {r["p"]: r["l"] for r in got.collect()} == {0: ["a"], 5: ["a", "b"], 9: ["a", "b"], 10: ["b"], 24: ["b"]}


def test_loudest_by_stretches(spark):
    rng = random.Random(5)
    values = {k: [rng.choice((0.0, 1.0, 2.0, 7.5, None)) for _ in range(n)] for k, n in (("a", 83), ("b", 4), ("c", 1))}
    df = spark.createDataFrame([(k, i, v) for k, row in values.items() for i, v in enumerate(row)], "k string, i long, v double").repartition(3)
    low = lambda v: -1.0 if v is None else v
    want = {}
    for k, row in values.items():
        for i in range(len(row)):
            seen = [(low(row[min(max(i + w, 0), len(row) - 1)]), -w) for w in range(-5, 6)]
            want[k, i] = -max(seen)[1]
    for size in (1, 7, 100_000):
        assert {(r["k"], r["i"]): r["offset"] for r in signal.loudest(df, ["k"], "i", "v", 5, size).collect()} == want
    at = spark.createDataFrame([("a", 0, "x"), ("a", 0, "x"), ("a", 82, "y"), ("b", 3, "z")], "k string, i long, name string")
    got = signal.loudest_nearby(df, at, ["k"], "i", "v")
    assert got.columns == ["k", "i", "name", "offset"]
    assert sorted(tuple(r) for r in got.collect()) == [("a", 0, "x", want["a", 0])] * 2 + [("a", 82, "y", want["a", 82]), ("b", 3, "z", want["b", 3])]
