"""Spans that hold a point, counted: against all pairs, and without making them."""

import random

import pytest
from pyspark.sql import functions as F

from framelark.operators import runs, stabs
from framelark.plans import event_queries


def most_rows(spark, make):
    """The largest number of rows that an operator of a query's jobs put out, and the query's rows."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsList().size()
    found = make().collect()
    spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    runs_, most = store.executionsList(), 0
    for i in range(before, runs_.size()):
        one = runs_.apply(i)
        values = store.executionMetrics(one.executionId())
        for j in range(one.metrics().size()):
            m = one.metrics().apply(j)
            value = values.get(m.accumulatorId())
            if m.name() == "number of output rows" and value.isDefined():
                most = max(most, int(value.get().replace(",", "")))
    return most, found


@pytest.mark.parametrize("rows", [1, 8, 64, 1 << 16])
def test_counts_are_those_of_all_pairs(spark, rows):
    rng = random.Random(rows)
    spans = [(rng.randrange(3), rng.choice("pqrs") + str(i), a, a + rng.choice((-1, 0, 1, 3, 20, 200, 900))) for i in range(150) for a in [rng.randrange(1000)]]
    spans += [(0, "a", -50, 5000), (None, "b", 0, 9), (1, None, 0, 900), (1, "c", None, 7), (2, "d", 5, 5), (2, "e", 400, 401)]
    points = [(rng.randrange(4), rng.randrange(-5, 1300), i // 2) for i in range(400)] + [(None, 3, -1), (0, None, -2), (2, 400, -3), (2, 401, -4)]
    held = {}
    for j, (k, at, _) in enumerate(points):
        names = [v for s, v, a, b in spans if None not in (s, k, at, a, b) and s == k and a <= at < b]
        if names:
            held[j] = (len(names), min((v for v in names if v is not None), default=None))
    want = sorted((*points[j], *v) for j, v in held.items())
    spans = [(k, v, a, float(b)) for k, v, a, b in spans]
    points = spark.createDataFrame(points, "k int, p long, id long").repartition(5)
    spans = spark.createDataFrame(spans, "k int, label string, a long, b double").repartition(3)
    got = stabs.stab_counts(points, spans, ["k"], "p", "a", "b", "label", rows)
    assert got.columns == ["k", "p", "id", "n", "least"]
    assert sorted(tuple(r) for r in got.collect()) == want
    pairs = runs.stabbed(points, spans, ["k"], "p", "a", "b", 8)
    assert sum(r[3] for r in want) == pairs.count()


def test_without_spans(spark):
    points = spark.createDataFrame([(3,)], "p long")
    assert stabs.stab_counts(points, spark.createDataFrame([], "a long, b long, v long"), [], "p", "a", "b", "v").collect() == []


def test_rows_grow_with_the_input_and_not_with_pairs(spark, tmp_path):
    """Every long span holds most clicks: 2,000 spans and 2,000 clicks make over a million pairs."""
    i = F.col("id")
    kind = F.when(i % 2 == 0, "error").otherwise("click")
    ts = F.expr("timestampadd(SECOND, CAST(id % 977 AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')")
    e = spark.range(4000).select(F.when(i % 2 == 0, i * 50 + 100).otherwise(i * 50).alias("event_id"), ts.alias("ts"), (i % 7).alias("user_id"), kind.alias("event_type"), F.lit(25.0).alias("value"), F.lit("{}").alias("props"))
    e.write.parquet(str(tmp_path / "events.parquet"))
    most, found = most_rows(spark, lambda: event_queries.q_stab_long(spark, str(tmp_path)))
    assert sum(r["n"] for r in found) > 1_000_000 and most < 40_000
