"""Windows, runs, numbers and sums over stretches against plain Python, with borders everywhere."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from framelark.operators import runs, signal, stretches

KEYS = [None, "a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    """Rows (k, i, f, v) of three keys, one of them null, and of one row; i has no gaps."""
    rng = random.Random(4)
    own = {k: [(k, i, rng.random() < 0.6, rng.choice([None, 1.0, 2.0, 2.0, 5.5])) for i in range(n)] for k, n in zip([*KEYS, "one"], (97, 230, 41, 1), strict=True)}
    df = spark.createDataFrame([r for v in own.values() for r in v], "k string, i long, f boolean, v double").repartition(5).cache()
    return own, df


def taken(df, column, order="i"):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r[order]):
        out.setdefault(r["k"], []).append(r[column])
    return out


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_windows_of_fixed_reach(rows, size):
    own, df = rows
    got = taken(runs.spread(df, ["k"], "i", "f", "g", 3, 2, size), "g")
    assert got == {k: [any(x[2] for x in v[max(0, i - 3) : i + 3]) for i in range(len(v))] for k, v in own.items()}
    by_one = stretches.by_stretches(df, ["k"], "i", 3, 0, lambda d, k: d.withColumn("before", F.lag("i", 3).over(runs.over(k, "i"))), size)
    assert taken(by_one, "before") == {k: [i - 3 if i >= 3 else None for i in range(len(v))] for k, v in own.items()}
    numbers = df.withColumn("x", F.coalesce("v", F.lit(0.5)))
    whole = taken(numbers.withColumn("s", runs.smoothed5("x", ["k"], "i")), "s")
    assert taken(runs.smoothed(numbers, ["k"], "i", "x", "s", size), "s") == whole
    whole = runs.opened(runs.closed(df, ["k"], "i", "f", 3), ["k"], "i", "f", 4)
    assert taken(runs.opened(runs.closed(df, ["k"], "i", "f", 3, size), ["k"], "i", "f", 4, size), "f") == taken(whole, "f")
    assert taken(signal.near_repeats(numbers, ["k"], "i", "x", 4, size), "burst") == taken(signal.near_repeats(numbers, ["k"], "i", "x", 4), "burst")


@pytest.mark.parametrize("size", [1, 3, 10, 1000])
def test_runs_across_borders(rows, size):
    own, df = rows
    want, bands = set(), set()
    for k, v in own.items():
        for on, g in groupby(v, key=lambda x: x[2]):
            g = list(g)
            if on:
                want.add((k, g[0][1], g[-1][1] + 1))
        for value, g in groupby(v, key=lambda x: x[3]):
            g = list(g)
            bands.add((k, value, g[0][1], g[-1][1], len(g)))
    assert {tuple(r) for r in runs.intervals(df, ["k"], "i", F.col("f"), size).collect()} == want
    assert {(r["k"], r["i"]) for r in runs.rising(df, ["k"], "i", F.col("f"), size).collect()} == {(k, a) for k, a, _ in want}
    assert {(r["k"], r["i"]) for r in runs.falling(df, ["k"], "i", F.col("f"), size).collect()} == {(k, b - 1) for k, _, b in want}
    got = runs.bands(df, ["k"], "i", "v", size).collect()
    assert {(r["k"], r["v"], r["first"], r["last"], r["n"]) for r in got} == bands and len(got) == len(bands)
    apart = df.filter("i % 10 <> 4")  # gaps end intervals
    want = {(k, i) for k, i, f in ((x[0], x[1], x[2]) for v in own.values() for x in v) if f and i % 10 != 4}
    got = {(r["k"], i) for r in runs.intervals(apart, ["k"], "i", F.col("f"), size).collect() for i in range(r["first"], r["last_excl"])}
    assert got == want


@pytest.mark.parametrize("parts", [1, 6])
def test_numbers_and_running_sums(rows, parts):
    own, df = rows
    order = lambda x: (x[3] is not None, x[3] or 0, x[1])
    ranked = stretches.numbered(df, ["k"], ["v", "i"], "n", "all", parts)
    want = {k: [x[1] for x in sorted(v, key=order)] for k, v in own.items()}
    assert taken(ranked, "i", "n") == want and {(r["k"], r["all"]) for r in ranked.collect()} == {(k, len(v)) for k, v in own.items()}
    for size in (1, 8, 1000):
        sums, so_far = taken(stretches.running(ranked, ["k"], "n", "v", "upto", size), "upto", "n"), {}
        for k, v in own.items():
            total, so_far[k] = 0.0, []
            for x in sorted(v, key=order):
                total += x[3] or 0
                so_far[k].append(total)
        assert sums == so_far
    every = sorted((x for v in own.values() for x in v), key=lambda x: (*order(x), x[0] is not None, x[0] or ""))
    got = stretches.numbered(df, [], ["v", "i", "k"], "n", parts=parts).orderBy("n").collect()
    assert [(r["n"], r["k"], r["i"]) for r in got] == [(n, x[0], x[1]) for n, x in enumerate(every)]
    assert stretches.numbered(df.limit(0), [], "i").count() == stretches.numbered(df.limit(0), ["k"], "i").count() == 0


def test_one_entity_uses_many_tasks(spark):
    """All rows are of one key, and no task of a window gets more than a few stretches of them."""
    df = spark.range(20_000).select(F.lit("x").alias("k"), F.col("id").alias("i"), (F.col("id") % 3 == 0).alias("f"))

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        here = lambda d, k: d.withColumn("before", F.lag("i").over(runs.over(k, "i"))).withColumn("t", F.spark_partition_id())
        windows = stretches.by_stretches(df, ["k"], "i", 1, 1, here, 100)
        numbers = stretches.numbered(df, ["k"], "i", "n", parts=8).withColumn("t", F.spark_partition_id())
        for found in (windows, numbers):
            sizes = [r["count"] for r in found.groupBy("t").count().collect()]
            assert sum(sizes) == 20_000 and len(sizes) >= 4 and max(sizes) < 12_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = signal.rank01(df, [], "i", "k")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
