"""Ranks by cells and joins by dyadic cells, against sorting and comparing everything."""

import math
import random

import pytest
from pyspark.sql import functions as F

from framelark.operators import runs, selection


def test_ranks(spark):
    rng = random.Random(2)
    groups = {
        None: [rng.random() for _ in range(500)], "ties": [1.0] * 300 + [2.0], "one": [-3.5], "far": [10.0 ** rng.randrange(-9, 9) * rng.choice([1, -1]) for _ in range(200)],
        "ends": [-math.inf, math.inf, 0.0, -0.0, 1.7e308, -1.7e308, 5e-324, -5e-324], "near": [1.0, math.nextafter(1, 2), math.nextafter(1, 0)], "inf": [math.inf] * 3 + [-math.inf] * 3 + [4.0],
    }
    rows = [(k, v) for k, own in groups.items() for v in own] + [("one", None), ("ties", float("nan")), ("none", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = selection.selected(df, ["k"], "v", lambda n: {"least": F.lit(0), "third": F.floor(n / 3), "last": n - 1, "seven": F.lit(7)}).collect()
    assert {r["k"] for r in got} == set(groups)
    for r in got:
        own = sorted(groups[r["k"]])
        assert (r["n"], r["least"], r["third"], r["last"], r["seven"]) == (len(own), own[0], own[len(own) // 3], own[-1], own[7] if len(own) > 7 else None)


def test_hot_group_and_no_groups(spark, monkeypatch):
    """The hot group isn't shuffled; without keys all rows are one group."""
    df = spark.range(5000).select(F.when(F.col("id") % 10 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"), (F.col("id") * 7919 % 5000).cast("double").alias("v"))
    got = {r["k"]: (r["n"], r["median"]) for r in selection.median(df, ["k"], "v").collect()}
    ones = sorted(i * 7919 % 5000 for i in range(5000) if i % 10 or i == 1)
    assert got[1] == (len(ones), (ones[len(ones) // 2] + ones[(len(ones) - 1) // 2]) / 2) and len(got) == 501
    assert [tuple(r) for r in selection.median(df, [], "v").collect()] == [(5000, 2499.5)]
    monkeypatch.setattr(selection, "HOT", 1)  # no group is hot
    assert {r["k"]: (r["n"], r["median"]) for r in selection.median(df, ["k"], "v").collect()} == got
    assert selection.median(df.limit(0), ["k"], "v").count() == selection.median(df.limit(0), [], "v").filter("n > 0").count() == 0


def test_cells_cover_spans_once(spark):
    rng = random.Random(1)
    spans = [(a, a + n) for a, n in [(0, 0), (0, 1023), (-5, 3), (-1024, 2048), (1, 1022), (7, 0)] + [(rng.randrange(-300, 300), rng.randrange(200)) for _ in range(60)]]
    df = spark.createDataFrame(spans, "a long, b long")
    got = df.select("a", "b", *[runs.cells_of(F.col("a"), F.col("b"), k).alias(str(k)) for k in range(14)]).collect()
    for r in got:
        covered = [x for k in range(14) for c in r[str(k)] for x in range(c << k, c + 1 << k)]
        assert sorted(covered) == list(range(r["a"], r["b"] + 1))
        assert all(len(r[str(k)]) <= 2 for k in range(14)) and sum(len(r[str(k)]) for k in range(14)) <= 2 * (r["b"] - r["a"] + 1).bit_length()


@pytest.mark.parametrize("unit", [1, 0.25, 7, 10_000])
def test_points_in_spans(spark, unit):
    rng = random.Random(3)
    points = [(rng.choice(["x", "y"]), i, rng.randrange(-400, 400) / 4) for i in range(300)]
    spans = [(rng.choice(["x", "y"]), j, a, a + rng.choice([0, -1, 0.25, 1, 5, 63.75, 64, 200])) for j, a in enumerate(rng.randrange(-400, 400) / 4 for _ in range(80))]
    spans += [("x", 900, -1000.0, 1000.0), ("y", 901, 2.0, 2.0)]
    p, s = spark.createDataFrame(points, "k string, i long, t double"), spark.createDataFrame(spans, "k string, j long, a double, b double")
    got = [(r["i"], r["j"]) for r in runs.stabbed(p, s, ["k"], "t", "a", "b", unit).collect()]
    assert sorted(got) == sorted((i, j) for k, i, t in points for m, j, a, b in spans if k == m and a <= t < b)
    assert runs.stabbed(p, s.limit(0), ["k"], "t", "a", "b", unit).count() == 0
