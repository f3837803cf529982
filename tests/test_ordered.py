"""Documents, binaries and merged streams in parts against Python's own."""

import json
import random
import struct

import pytest
from pyspark.sql import functions as F

from framelark.operators import ordered
from framelark.plans import media, tracks


def joined(parts, keys, column="text"):
    out = {}
    for r in sorted(parts.collect(), key=lambda r: r["part"]):
        key = tuple(r[k] for k in keys)
        before = out.get(key, r[column][:0])
        assert r["offset"] == len(before if isinstance(before, bytes | bytearray) else before.encode()) and r["part"] >= 0
        out[key] = before + r[column]
    return out


@pytest.mark.parametrize("part", [1, 3, 1000])
def test_documents_in_parts(spark, part):
    rng = random.Random(1)
    rows = [(k, i, rng.choice(["é", "x", None, '"', ""])) for k in ("a", "b", None) for i in range(rng.randrange(3, 20))] + [("none", 0, None)]
    df = spark.createDataFrame(rows, "id string, i long, t string").repartition(3)
    got = joined(ordered.document(df, ["id"], "i", F.when(F.col("t").isNotNull(), F.concat(F.lit("<"), "t", F.lit(">"))), part=part), ["id"])
    assert got == {(k,): "[" + ",".join(f"<{t}>" for key, _, t in rows if key == k and t is not None) + "]" for k in ("a", "b", None, "none")}
    assert joined(ordered.document(df, [], ["id", "i"], F.lit("1"), "(", ")", part=part), [])[()].count("1") == len(rows)
    assert ordered.document(df.limit(0), ["id"], "i", F.col("t")).count() == 0


def test_tracks_in_parts_are_the_tracks(spark, tmp_path):
    values = spark.createDataFrame([(i, v) for i, v in enumerate([1.5, None, float("nan"), float("inf"), -2.25, 1e-7, 3.0])], "i long, v double")
    whole = json.loads(tracks.series(values, "s", "S", 0.0, 0.04, unit='m"').first()["body"])
    parts = tracks.series_parts(values, 0.0, 0.04, 'm"', part=2)
    assert json.loads(joined(parts, [])[()]) == whole and parts.count() == 4
    cues = spark.createDataFrame([(2.0, 3.0, "b"), (1.0004, 2.0, 'a "'), (1.0, 2.0, "a")], "a double, b double, text string")
    assert json.loads(joined(tracks.text_parts(cues, part=2), [])[()]) == json.loads(tracks.text(cues, "t", "T").first()["body"])
    spans = spark.createDataFrame([("x", 1, 0.12345, 2.0), ("x", 0, 0.0, 0.1), ("none", None, None, None)], "label string, order long, a double, b double")
    labels = {k[0]: json.loads(v) for k, v in joined(tracks.interval_parts(spans, part=1), ["label"]).items()}
    assert labels == json.loads(tracks.intervals(spans, "i", "I").first()["body"])["labels"]
    many = spark.range(1000).select(F.when(F.col("id") < 300, "one").otherwise("two").alias("id"), F.col("id").alias("i"), F.col("id").cast("double").alias("v"))
    ordered.write_document(tracks.series_parts(many, 0.0, 1.0, keys=["id"], part=7), str(tmp_path / "docs"))
    for id, n in (("one", range(300)), ("two", range(300, 1000))):
        text = "".join(p.read_text().replace("\n", "") for p in sorted((tmp_path / "docs" / f"id={id}").glob("part-*")))
        assert json.loads(text)["values"] == [float(i) for i in n]


@pytest.mark.parametrize("part", [1, 4, 10_000])
def test_binaries_in_parts(spark, part):
    rng = random.Random(2)
    rows = [(p, u, rng.choice([rng.random(), -0.0, 1e30, 5.5])) for p in (1, 2) for u in range(3) for _ in range(rng.randrange(9))]
    df = spark.createDataFrame(rows, "patient long, unit_id long, t double").repartition(3)
    want = {(p,): b"".join(struct.pack("<f", t) for _, u, t in sorted(r for r in rows if r[0] == p)) for p in (1, 2)}
    parts = tracks.spike_parts(df, part)
    assert {k: bytes(v) for k, v in joined(parts, ["patient"], "data").items()} == want
    assert {(r["patient"],): bytes(r["data"]) for r in tracks.spike_binary(df).collect()} == want
    back = ordered.read_numbers(parts, ["patient"]).orderBy("patient", "place").collect()
    assert [r["value"] for r in back if r["patient"] == 1] == list(struct.unpack(f"<{len(want[1,]) // 4}f", want[1,]))


@pytest.mark.parametrize("stretch", [1, 5, 1000])
def test_merged_streams(spark, stretch):
    rng = random.Random(3)
    packets = [("f", s, i, rng.choice([None, *range(10)]), rng.choice([None, 1, 5])) for s in range(3) for i in range(30)]
    df = spark.createDataFrame(packets, "file string, stream int, seq int, dts int, size long").repartition(4)
    at = 0
    got = ordered.laid_out(df.filter("dts IS NOT NULL"), ["file"], ["dts", "stream", "seq"], "size", stretch=stretch).orderBy("place").collect()
    for i, (p, r) in enumerate(zip(sorted((p for p in packets if p[3] is not None), key=lambda p: (p[3], p[1], p[2])), got, strict=True)):
        assert (r["place"], r["offset"], r["stream"], r["seq"]) == (i, at, p[1], p[2])
        at += p[4] or 0
    assert media.mux_plan(df, keys=["file"]).count() == len(got)
