"""Resampling against sines that are known at every point, and against one array."""

import numpy as np
import pytest

from framelark.functions.axis import N_FRAMES
from framelark.operators import resample
from framelark.plans import media

#: Largest error of a sine well below the cut-off, away from the ends.
ERROR = 2e-4


def chunks(spark, x, lengths, key="a", start=0):
    rows, at, i = [], 0, 0
    while at < len(x):
        n = lengths[i % len(lengths)]
        rows.append((key, start + at, x[at : at + n].tolist()))
        at, i = at + n, i + 1
    return spark.createDataFrame(rows, "recording string, start long, x array<double>").repartition(3)


def whole(out):
    rows = sorted(out.collect(), key=lambda r: r["first_sample"])
    assert all(a["first_sample"] + len(a["y"]) == b["first_sample"] for a, b in zip(rows, rows[1:], strict=False))
    return np.concatenate([r["y"] for r in rows])


@pytest.mark.parametrize("film_fps", [25.0, 24000 / 1001, 24.0])
def test_a_sine_at_the_films_speed(spark, film_fps):
    step, n = 25 / film_fps, 3000
    x = np.sin(2 * np.pi * 0.05 * np.arange(3400))
    plan = spark.createDataFrame([("a", 0, 100, n, 7.0, step)], "recording string, segment int, first_sample long, n_samples long, start double, step double")
    y = whole(resample.resampled(chunks(spark, x, [500]), plan, ["recording"], block=700, cell=256))
    assert len(y) == n
    exact = np.sin(2 * np.pi * 0.05 * (7 + np.arange(n) * step))
    assert np.abs(y - exact)[100:-100].max() < ERROR


def test_any_chunks_and_blocks_give_the_same(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=900)
    plan = spark.createDataFrame([("a", 0, 0, 400, 3.0, 1.0427), ("a", 1, 400, 350, 520.5, 0.7), ("a", 2, 750, 0, 0.0, 1.0), ("a", 3, 750, 5, None, 1.0), ("b", 0, 0, 6, 0.0, 1.0)],
                                 "recording string, segment int, first_sample long, n_samples long, start double, step double")
    found = []
    for lengths, block, cell in (([900], 1 << 16, 1 << 16), ([1, 5, 17], 64, 32), ([100], 1, 1000), ([333], 7, 11)):
        out = resample.resampled(chunks(spark, x, lengths), plan, ["recording"], block=block, cell=cell)
        assert {(r["recording"], r["segment"]) for r in out.collect()} == {("a", 0), ("a", 1), ("b", 0)}
        assert whole(out.filter("recording = 'b'")).tolist() == [0.0] * 6  # no source: silence
        found.append(whole(out.filter("recording = 'a'")))
    assert all(f == pytest.approx(found[0], abs=1e-12) for f in found) and len(found[0]) == 750
    for k, start, step in ((0, 3.0, 1.0427), (399, 3.0, 1.0427), (400, 520.5, 0.7), (749, 520.5, 0.7)):
        place = start + (k - (400 if k >= 400 else 0)) * step
        own = np.arange(900)
        own = own[own >= np.ceil(start)]
        assert found[0][k] == pytest.approx((x[own] * resample.kernel(place - own, step)).sum(), abs=1e-12)


def test_missing_parts_are_silence_and_lengths_exact(spark):
    mapping = spark.createDataFrame([("a", 24000 / 1001, 2, N_FRAMES - 20, 3, 0.0)], "recording string, film_fps double, head long, brk long, gap long, t0 double")
    x = chunks(spark, np.ones(200), [64], start=40)
    out = media.retimed_sound(x, mapping, 100.0, rate=100)
    sizes = {(r["segment"], r["first_sample"]): len(r["y"]) for r in out.collect()}
    assert sum(sizes.values()) == N_FRAMES * 100 // 25
    first = next(r["y"] for r in out.collect() if r["first_sample"] == 0)
    at = (np.arange(len(first)) * 25 / (24000 / 1001)) + round(2 / (24000 / 1001) * 100)
    assert np.abs(np.array(first)[(at > 80) & (at < 200)] - 1).max() < 1e-3 and np.abs(np.array(first)[(at > 300)]).max() < 1e-12
