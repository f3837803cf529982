"""What a viewer shows between two times: each function gives rows for a window t0 <= t < t1 of its width in pixels or bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def visible(spans: DataFrame, a: str, b: str, t0: float, t1: float) -> DataFrame:
    """Intervals or text that touch the window."""
    return spans.filter((F.col(b) >= t0) & (F.col(a) < t1))


def current(spans: DataFrame, keys: list[str], a: str, b: str, t: float) -> DataFrame:
    """The interval or text at t: of each key the one that ends first after t, if it has begun."""
    held = spans.filter((F.col(b) >= t + 1e-9) & (F.col(a) <= t))
    columns = [c for c in spans.columns if c not in keys]
    return held.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(b, a)).alias("_s")).select(*keys, "_s.*")


def bin_of(t: str, t0: float, t1: float, bins: int) -> Column:
    return F.floor((F.col(t) - t0) / (t1 - t0) * bins).cast("long")


def min_max(samples: DataFrame, keys: list[str], t: str, v: str, t0: float, t1: float, width: int, shared_ends: bool = False) -> DataFrame:
    """(keys, bin, low, high, n) of the samples of each pixel, without null and NaN. With shared_ends a sample that stands on
    the border of two pixels counts in both."""
    seen = samples.filter((F.col(t) >= t0) & (F.col(t) < t1) & F.col(v).isNotNull() & ~F.isnan(v))
    place = (F.col(t) - t0) / (t1 - t0) * width
    bins = F.array(F.floor(place).cast("long"))
    if shared_ends:
        bins = F.when((place == F.floor(place)) & (place > 0), F.array(F.floor(place).cast("long") - 1, F.floor(place).cast("long"))).otherwise(bins)
    return seen.withColumn("bin", F.explode(bins)).groupBy(*keys, "bin").agg(F.min(v).alias("low"), F.max(v).alias("high"), F.count(v).alias("n"))


def unit_rates(spikes: DataFrame, keys: list[str], t: str) -> DataFrame:
    """(keys, n, rate): spikes over the time from first to last, a second at least."""
    return spikes.groupBy(*keys).agg(F.count(t).alias("n"), (F.count(t) / F.greatest(F.max(t) - F.min(t), F.lit(1.0))).alias("rate"))


def population_rate(spikes: DataFrame, t: str, t0: float, t1: float, bins: int, units: int) -> DataFrame:
    """(bin, rate) for every bin: spikes a second and unit."""
    seen = spikes.filter((F.col(t) >= t0) & (F.col(t) < t1)).groupBy(bin_of(t, t0, t1, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = spikes.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(seen, "bin", "left").select("bin", (F.coalesce("n", F.lit(0)) / ((t1 - t0) / bins) / units).alias("rate"))


def heat(spikes: DataFrame, keys: list[str], t: str, t0: float, t1: float, bins: int) -> DataFrame:
    """(keys, bin, n, intensity): counts against four times what the unit's rate lets expect, from 0.08 to 1."""
    rates = unit_rates(spikes, keys, t).select(*keys, "rate")
    seen = spikes.filter((F.col(t) >= t0) & (F.col(t) < t1)).groupBy(*keys, bin_of(t, t0, t1, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    expected = F.col("rate") * ((t1 - t0) / bins)
    shade = F.least(F.greatest(F.col("n") / (4 * expected + 1e-9), F.lit(0.08)), F.lit(1.0))
    return seen.join(rates, keys).select(*keys, "bin", "n", shade.alias("intensity"))


def unit_rows(units: DataFrame, by_region: bool, patients: list[int] | None = None, regions: list[str] | None = None, single_only: bool = False) -> DataFrame:
    """Chosen units with `row`, their place from the top: by patient, region and unit, or by region first."""
    rows = units
    for column, chosen in (("patient", patients), ("region", regions)):
        rows = rows if chosen is None else rows.filter(F.col(column).isin(chosen))
    rows = rows.filter("single_unit") if single_only else rows
    order = ["region", "patient", "unit_id"] if by_region else ["patient", "region", "unit_id"]
    return rows.withColumn("row", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)) - 1)  # as many rows as a screen has


def first_patients(units: DataFrame, n: int = 3) -> DataFrame:
    """The n patients with the smallest numbers: what is shown at first. The limit is the feature."""
    return units.select("patient").distinct().orderBy("patient").limit(n)


def window(spans: DataFrame, samples: DataFrame, spikes: DataFrame, t0: float, t1: float, width: int) -> DataFrame:
    """All that a view of width pixels shows of t0 <= t < t1, as rows (track, label, bin, a, b, low, high, n): intervals and texts
    (track, label, a, b) that touch it; of signals (track, t, v) each pixel's range; of spikes (patient, unit_id, t) their number by
    unit and pixel, the patient as track and the unit as label."""
    seen = visible(spans, "a", "b", t0, t1).select("track", "label", "a", "b")
    drawn = min_max(samples, ["track"], "t", "v", t0, t1, width)
    fired = spikes.filter((F.col("t") >= t0) & (F.col("t") < t1)).groupBy(F.col("patient").cast("string").alias("track"), F.col("unit_id").cast("string").alias("label"), bin_of("t", t0, t1, width).alias("bin"))
    fired = fired.agg(F.count(F.lit(1)).alias("n"))
    return seen.unionByName(drawn, allowMissingColumns=True).unionByName(fired, allowMissingColumns=True).select("track", "label", "bin", "a", "b", "low", "high", "n")


def nearest_sample(t: float, t0: float, dt: float, n: int) -> int | None:
    """The sample under a pointer at t."""
    i = round((t - t0) / dt)
    return i if 0 <= i < n else None
