"""The frame axis: frames are integers at 25 a second, times are seconds, and a mapping leads to another recording's clock."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the axis.
RATE, N_FRAMES, ANALYSIS_FIRST, ANALYSIS_LAST = 25, 125_743, 918, 119_079
FRAME_SECONDS, DURATION = 0.04, N_FRAMES / RATE
#: What a frame time may fall short of its frame's start.
TOLERANCE = 1e-9


def _c(x: Any) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def axis(spark: SparkSession, n: int = N_FRAMES) -> DataFrame:
    """The dense axis, column p."""
    return spark.range(n).withColumnRenamed("id", "p")


def seconds(p: Any) -> Column:
    return _c(p) * F.lit(FRAME_SECONDS)


def frame_at(t: Any) -> Column:
    """The frame that shows at t. Multiplying by 25 would round other times up than dividing by a 25th does."""
    return F.floor(_c(t) / F.lit(1.0 / RATE) + F.lit(TOLERANCE)).cast("long")


def frame_of_name(name: Any) -> Column:
    """Frame of a file name like frame_000919.jpg: names count from 1, after their last underscore."""
    return F.regexp_extract(_c(name), r"_(\d+)\.[^_]*$", 1).cast("long") - 1


def name_of_frame(p: Any) -> Column:
    number = (_c(p) + 1).cast("string")
    return F.concat(F.lit("frame_"), F.when(F.length(number) < 6, F.lpad(number, 6, "0")).otherwise(number), F.lit(".jpg"))


def half_even(x: Any) -> Column:
    """Nearest integer; halves go to the even one."""
    return F.rint(_c(x))


@dataclass(frozen=True)
class Mapping:
    """Where frames of the axis stand in a recording: head frames before the first, and gap more from frame brk on.

    Fields are numbers, or columns of a table of variants that are to be tried in one job."""

    film_fps: Any
    head: Any
    brk: Any
    gap: Any
    t0: Any = 0.0

    def source_frame(self, p: Any) -> Column:
        return _c(p) + _c(self.head) + F.when(_c(p) >= _c(self.brk), _c(self.gap)).otherwise(F.lit(0))

    def source_time(self, p: Any) -> Column:
        return self.source_frame(p) / _c(self.film_fps) + _c(self.t0)

    def to_source(self, t: Any) -> Column:
        """Source time of any axis time."""
        return self.source_time(_c(t) * F.lit(float(RATE)))

    def to_axis(self, t: Any) -> Column:
        """Axis time of a source time; null in the removed section, before the head and beyond the axis (its very end counts)."""
        frame = (_c(t) - _c(self.t0)) * _c(self.film_fps) - _c(self.head)
        later = frame - _c(self.gap)
        p = F.when(frame < _c(self.brk), frame).when(later >= _c(self.brk), later)
        return F.when((p >= 0) & (p <= N_FRAMES), p / F.lit(float(RATE)))

    def struct(self) -> Column:
        kinds = {"film_fps": "double", "head": "long", "brk": "long", "gap": "long", "t0": "double"}
        return F.struct(*[_c(v).cast(kinds[k]).alias(k) for k, v in self.__dict__.items()])

    def to_dict(self) -> dict:
        return asdict(self)

    def speed(self) -> Any:
        return RATE / self.film_fps


IDENTITY = Mapping(float(RATE), 0, N_FRAMES, 0)
FROM_JSON = "film_fps double, head long, brk long, gap long, t0 double"


def mapping_from_json(text: Any) -> Mapping:
    """The mapping that a JSON column holds, with columns for fields."""
    parsed = F.from_json(_c(text), FROM_JSON)
    return Mapping(*[parsed[k] for k in ("film_fps", "head", "brk", "gap", "t0")])
