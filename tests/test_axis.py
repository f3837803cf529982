import pytest
from pyspark.sql import functions as F

from framelark.functions import axis, text

M = axis.Mapping(24000 / 1001, 25, 97210, 11020)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_names_and_frames(spark):
    assert value(spark, axis.frame_of_name("frame_000919.jpg")) == 918
    assert value(spark, axis.name_of_frame(918)) == "frame_000919.jpg"
    assert value(spark, axis.name_of_frame(1_234_566)) == "frame_1234567.jpg"
    for t, p in ((0.0, 0), (0.04, 1), (36.72, 918), (0.0399, 0)):
        assert value(spark, axis.frame_at(t)) == p
    assert value(spark, axis.seconds(918)) == pytest.approx(36.72)
    assert value(spark, axis.seconds(119079)) == pytest.approx(4763.16)
    assert value(spark, axis.half_even(2.5)) == 2


def test_mapping(spark):
    for p, frame in ((0, 25), (97209, 97234), (97210, 108255), (125742, 136787)):
        assert value(spark, M.source_frame(p)) == frame
    for t in (0.0, 4.0, 97209.5 * 0.04, 97210.5 * 0.04, 5000.0):
        assert value(spark, M.to_axis(M.to_source(t))) == pytest.approx(t, abs=1e-9)
    assert value(spark, M.to_axis((97210 + 25 + 5000) * 1001 / 24000)) is None
    assert value(spark, M.to_axis(0.5)) is None
    assert value(spark, M.to_source(11.0) - M.to_source(10.0)) == pytest.approx(25 * 1001 / 24000)
    assert value(spark, axis.IDENTITY.source_time(918)) == pytest.approx(36.72)
    assert value(spark, axis.IDENTITY.source_frame(axis.N_FRAMES - 1)) == axis.N_FRAMES - 1
    assert value(spark, axis.IDENTITY.to_axis(axis.DURATION)) == pytest.approx(axis.DURATION)  # the very end still counts
    back = axis.mapping_from_json(F.to_json(M.struct()))
    assert value(spark, back.source_frame(97210)) == 108255


def test_text(spark):
    assert value(spark, text.time_code(3661.0015)) == "01:01:01,002"
    assert value(spark, text.time_code(0.5, ".")) == "00:00:00.500"
    assert value(spark, text.time_code(360000.0)) == "100:00:00,000"
    assert value(spark, text.clock(75.5)) == "01:15.50"
    assert value(spark, text.html_escaped('<a b="c">&')) == "&lt;a b=&quot;c&quot;&gt;&amp;"
    for header, want in (("bytes=0-9", (0, 9)), ("bytes=90-", (90, 99)), ("bytes=-5", (95, 99)), ("bytes=100-", None), ("x", None), ("bytes=50-400", (50, 99))):
        got = value(spark, text.byte_range(header, 100))
        assert (tuple(got) if got else None) == want
    assert value(spark, text.pcm16(0.5)) == 16383
    assert value(spark, text.pcm16(-7.0)) == -32767
    assert value(spark, text.tick_step(100.0, [1, 5, 10, 30])) == 10.0
    assert value(spark, text.tick_step(1e9, [1, 5])) == 600.0
