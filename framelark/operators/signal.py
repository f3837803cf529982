"""Detection on sampled signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.operators.runs import Keys, dilated, over
from framelark.operators.selection import selected
from framelark.operators.stretches import SIZE, by_stretches, numbered


def mean_abs_difference(a: Column, b: Column) -> Column:
    """Of two arrays of numbers of one length, in double precision; 0 if either is null."""
    total = F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)
    return F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(total / F.size(a))


#: Frames of a stretch where rows hold pictures.
PICTURES = 500


def frame_signal(frames: DataFrame, keys: Keys, index: str, pixels: str, size: int = PICTURES) -> DataFrame:
    """frames with `mad`, the mean absolute pixel difference from the frame before; 0 for the first. pixels goes."""

    def compared(d: DataFrame, k: Keys) -> DataFrame:
        return d.withColumn("mad", mean_abs_difference(F.col(pixels), F.lag(pixels).over(over(k, index))).cast("float")).drop(pixels)

    return by_stretches(frames, keys, index, 1, 0, compared, size)


def neighbours(value: str, keys: Keys, order: str) -> tuple[Column, Column]:
    """The values before and after, 0 beyond the ends."""
    w = over(keys, order)
    return F.coalesce(F.lag(value).over(w), F.lit(0.0)), F.coalesce(F.lead(value).over(w), F.lit(0.0))


def cuts(df: DataFrame, keys: Keys, index: str, value: str, least: float = 8.0, times: float = 3.0, size: int = SIZE) -> DataFrame:
    """Rows whose value is above least and above `times` the larger neighbour."""
    df = by_stretches(df, keys, index, 1, 1, lambda d, k: d.withColumn("_high", F.greatest(*neighbours(value, k, index))), size)
    return df.filter((F.col(value) > least) & (F.col(value) > times * F.col("_high"))).drop("_high")


def repeats(value: str, keys: Keys, order: str, share: float = 0.15, motion: float = 1.5) -> Column:
    """Whether a row's value is far below both neighbours while those move: a frame shown twice."""
    a, b = neighbours(value, keys, order)
    low = F.least(a, b)
    return (F.col(value) < share * low) & (low > motion)


def marked_repeats(df: DataFrame, keys: Keys, index: str, value: str, reach: int = 8) -> DataFrame:
    """df with `burst`: whether a repeat is at most reach rows away. For use inside stretches.by_stretches()."""
    df = df.withColumn("_repeat", repeats(value, keys, index))
    return df.withColumn("burst", dilated(F.col("_repeat"), keys, index, reach, reach)).drop("_repeat")


def near_repeats(df: DataFrame, keys: Keys, index: str, value: str, reach: int = 8, size: int = SIZE) -> DataFrame:
    """marked_repeats() dealt by stretches."""
    return by_stretches(df, keys, index, reach + 1, reach + 1, lambda d, k: marked_repeats(d, k, index, value, reach), size)


def rank01(df: DataFrame, keys: Keys, value: str, tie: str, parts: int | None = None) -> DataFrame:
    """df with `score`, 0 to (n - 1) / n by rising value; equal values in the order of tie. Without keys, of all rows."""
    return numbered(df, keys, [value, tie], "_i", "_n", parts).withColumn("score", F.col("_i") / F.col("_n")).drop("_i", "_n")


def best(df: DataFrame, keys: Keys, value: str, index: str, last: bool = False) -> DataFrame:
    """One row for each key: (index, value) of the largest value; of equal ones the first index, or the last.

    Partial maxima of structs are combined before the shuffle."""
    rank = F.max_by(F.struct(index, value), F.struct(F.col(value), F.col(index) if last else -F.col(index)))
    return df.groupBy(*keys).agg(rank.alias("_best")).select(*keys, f"_best.{index}", f"_best.{value}")


def floor_percentile(df: DataFrame, keys: Keys, value: str, share: float = 0.995) -> DataFrame:
    """One row for each key: low = the smaller of 0 and the smallest value; high = the value at floor(share * (n - 1)) of the
    sorted ones, and 1 if that is 0. Null and NaN values are left out. No group is sorted."""
    found = selected(df, keys, value, lambda n: {"low": F.lit(0), "high": F.floor(share * (n - 1))})
    return found.select(*keys, F.least(F.lit(0.0), "low").alias("low"), F.when(F.col("high") == 0, F.lit(1.0)).otherwise(F.col("high")).alias("high"))


def loudest(df: DataFrame, keys: Keys, index: str, value: str, reach: int = 5, size: int = SIZE) -> DataFrame:
    """df with `offset`: where within reach rows of its dense index 0..n-1 the largest value is; of equal ones the first. Rows
    beyond the ends are the end row. size: rows of a stretch."""

    def found(d: DataFrame, k: Keys) -> DataFrame:
        most = F.max(F.struct(F.col(value).alias("_v"), (-F.col(index)).alias("_i"))).over(over(k, index).rowsBetween(-reach, reach))
        return d.withColumn("_found", -most["_i"])

    # the first of those that are row 0 is the farthest back
    offset = F.when(F.col("_found") == 0, -reach).otherwise(F.col("_found") - F.col(index)).cast("int")
    return by_stretches(df, keys, index, reach, reach, found, size).withColumn("offset", offset).drop("_found")


def loudest_nearby(df: DataFrame, at: DataFrame, keys: Keys, index: str, value: str, reach: int = 5, size: int = SIZE) -> DataFrame:
    """at (keys, index and more), rows of df by index, with their `offset` as of loudest(). It is found once for each row of df, so no row of
    at is copied, and at may hold one often."""
    rows = loudest(df.select(*keys, index, value), keys, index, value, reach, size).select(*keys, index, "offset")
    return at.join(rows, [*keys, index]).select(*at.columns, "offset")
