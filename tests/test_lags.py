"""Lag sums by blocks against one array of all points and samples."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelark.operators import asof, lags

LAGS = [round(-1.5 + 0.02 * i, 2) for i in range(151)]


def tables(spark, missing=()):
    rng = random.Random(5)
    grid = [(r, k, rng.random()) for r, a, b in (("a", 0, 900), ("b", 250, 400), (None, 7, 8)) for k in range(a, b) if k not in missing]
    points = [(r, v, rng.uniform(-5, 14), float(rng.random() < 0.5)) for r in ("a", "b", None, "without") for v in ("one", "two") for _ in range(120)]
    points += [("a", "one", None, 1.0), ("a", "one", 1.0, None)]
    return points, grid, spark.createDataFrame(points, "r string, v string, t double, y double").repartition(3), spark.createDataFrame(grid, "r string, k long, x double").repartition(3)


@pytest.mark.parametrize("block", [0.05, 1.0, 1000.0])
def test_correlations_at_all_lags(spark, block):
    points, grid, p, g = tables(spark)
    found = lags.lag_sums(p, g, ["r"], "v", LAGS, 0.01, block=block).collect()
    assert len(found) == 6 * len(LAGS)
    for row in found:
        own = np.array([(t, y) for r, v, t, y in points if (r, v) == (row["r"], row["v"]) and None not in (t, y)])
        k, x = np.array([(k, x) for r, k, x in grid if r == row["r"]]).T
        at = np.interp(own[:, 0] + row["lag"], (k + 0.5) * 0.01, x)
        y = own[:, 1]
        assert [row[s] for s in lags.SUMS] == pytest.approx([len(y), at.sum(), y.sum(), at @ at, y @ y, at @ y], rel=1e-9)


def test_correlation_is_numpys(spark):
    points, grid, p, g = tables(spark)
    for row in lags.lag_correlation(p.withColumnRenamed("r", "rec"), g.withColumnRenamed("r", "rec"), ["rec"], "v", [-0.3, 0.0, 1.5], 0.01).collect():
        own = np.array([(t, y) for r, v, t, y in points if (r, v) == (row["rec"], row["v"]) and None not in (t, y)])
        k, x = np.array([(k, x) for r, k, x in grid if r == row["rec"]]).T
        at = np.interp(own[:, 0] + row["lag"], (k + 0.5) * 0.01, x)
        assert row["r"] is None if at.std() < 1e-9 else row["r"] == pytest.approx(np.corrcoef(at, own[:, 1])[0, 1])


def test_missing_samples_and_grid_value(spark):
    """A point that begins at a missing sample has no value; one before it keeps the last. Both operators agree."""
    points, grid, p, g = tables(spark, missing={*range(300, 310), 700})
    for lag in (-0.5, 0.0, 0.24):
        one = lags.lag_sums(p, g, ["r"], "v", [lag], 0.01, block=0.7).orderBy("r", "v").collect()
        values = asof.grid_value(p.filter("t IS NOT NULL AND y IS NOT NULL AND r IS NOT NULL"), g.filter("r IS NOT NULL"), F.col("t") + lag, 0.01, keys=["r"]).filter("x IS NOT NULL")
        two = values.groupBy("r", "v").agg(F.count("x").alias("n"), F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("y")).alias("sxy")).orderBy("r", "v").collect()
        one = [r for r in one if r["r"]]
        assert [(r["r"], r["v"], r["n"]) for r in one] == [(r["r"], r["v"], r["n"]) for r in two]
        assert [r[s] for r in one for s in ("sx", "sxy")] == pytest.approx([r[s] for r in two for s in ("sx", "sxy")])


def test_shuffle_does_not_depend_on_lags(spark):
    """The same exchanges of the same rows, before the sums of each block."""
    _, _, p, g = tables(spark)
    plans = [lags.lag_sums(p, g, ["r"], "v", wanted, 0.01)._jdf.queryExecution().executedPlan().toString() for wanted in ([0.0], LAGS)]
    assert plans[0].count("Exchange hashpartitioning") == plans[1].count("Exchange hashpartitioning")
    assert all("CartesianProduct" not in x for x in plans)
