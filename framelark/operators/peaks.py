"""Histograms of differences and their peaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOW, HIGH = -3000, 30_000


def offsets(a: DataFrame, b: DataFrame, keys: list[str], at: str, of: str, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(keys, offset, n): how many pairs of a row of a and one of b with the same keys are offset apart, at - of, rounded half
    to even; low <= offset < high. Both sides meet by keys and stretches of high - low: an equality join, never all pairs."""
    width = high - low
    left = a.select(*keys, F.col(at).cast("double").alias("_x")).withColumn("_s", F.floor((F.col("_x") - low + 1) / width).cast("long"))
    right = b.select(*keys, F.col(of).cast("double").alias("_y")).withColumn("_s0", F.floor(F.col("_y") / width).cast("long"))
    # at - of in [low, high): at - low lies from of to of + width, so in of's stretch or the next; rounding adds one more
    right = right.withColumn("_s", F.explode(F.array(F.col("_s0"), F.col("_s0") + 1, F.col("_s0") + 2))).drop("_s0")
    pairs = left.join(right, [*keys, "_s"]).select(*keys, F.rint(F.col("_x") - F.col("_y")).cast("long").alias("offset"))
    return pairs.filter((F.col("offset") >= low) & (F.col("offset") < high)).groupBy(*keys, "offset").agg(F.count(F.lit(1)).alias("n"))


def dense(histogram: DataFrame, low: int, high: int, bin: str = "offset", n: str = "n") -> DataFrame:
    """Every bin from low to high - 1, with 0 where histogram has none."""
    bins = histogram.sparkSession.range(low, high).withColumnRenamed("id", bin)
    return bins.join(histogram.select(bin, n), bin, "left").select(bin, F.coalesce(n, F.lit(0)).cast("long").alias(n))


def peaks(histogram: DataFrame, n: int = 4, guard: int = 50, bin: str = "offset", count: str = "n") -> list[tuple[int, int]]:
    """The n largest bins by turns; each hides the bins from guard below it to guard - 1 above it from those that follow. Of
    equal bins the first counts. The histogram, which has as many rows as there are offsets at most, is kept for the turns; each is
    one small aggregate, of which a row comes to the driver."""
    out: list[tuple[int, int]] = []
    kept = rest = histogram.persist()
    for _ in range(n):
        top = rest.agg(F.max_by(F.struct(bin, count), F.struct(F.col(count), -F.col(bin)))).first()[0]
        if top is None:
            break
        out.append((int(top[0]), int(top[1])))
        rest = rest.filter((F.col(bin) < top[0] - guard) | (F.col(bin) >= top[0] + guard))
    kept.unpersist()
    return out


def significant(found: list[tuple[int, int]]) -> list[int]:
    """Offsets of peaks above 20 and above five times the background, the median of all but the first two."""
    tail = sorted(c for _, c in found[2:])
    half = len(tail) // 2
    background = 0.0 if not tail else float(tail[half]) if len(tail) % 2 else (tail[half - 1] + tail[half]) / 2
    return [o for o, c in found if c > max(20, 5 * background)]


def peaks_by(histogram: DataFrame, keys: list[str], n: int = 4, guard: int = 50, bin: str = "offset", count: str = "n") -> DataFrame:
    """(keys, peaks): as peaks(), for every key in one job: an array of n structs (offset, n); empty bins count as zero.

    A key's bins are one array, as long as there are offsets at most."""
    bins = histogram.groupBy(*keys).agg(F.collect_list(F.struct(F.col(count).alias("n"), (-F.col(bin)).alias("back"))).alias("_rest"))
    out = bins.withColumn("peaks", F.array().cast("array<struct<offset:long,n:long>>"))
    for _ in range(n):
        out = out.withColumn("_top", F.array_max("_rest"))
        top = F.struct(F.coalesce(-F.col("_top.back"), F.lit(0)).cast("long").alias("offset"), F.coalesce("_top.n", F.lit(0)).cast("long").alias("n"))
        out = out.withColumn("peaks", F.array_append("peaks", top))
        out = out.withColumn("_rest", F.filter("_rest", lambda b: (-b["back"] < -F.col("_top.back") - guard) | (-b["back"] >= -F.col("_top.back") + guard)))
    return out.drop("_rest", "_top")


def significant_in(found: Column) -> Column:
    """As significant(), of an array of four peaks."""
    background = (found[2]["n"] + found[3]["n"]) / 2
    return F.transform(F.filter(found, lambda p: p["n"] > F.greatest(F.lit(20.0), 5 * background)), lambda p: p["offset"])
