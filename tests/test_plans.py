import json
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framelark.functions.axis import Mapping
from framelark.plans import builders, cues, media, steps, tracks, viewport
from framelark.sources import assets, config, recordings, subtitles
from framelark.streaming import clock as stream

SRT = "﻿1\r\n00:00:01,000 --> 00:00:02,500\r\n<i>Hello</i>\r\nthere\r\n\r\n2\r\n00:01:00.250 --> 00:01:01,000 X1:0\r\n<b></b>\r\n\r\n3\r\n01:00:00,000 --> 01:00:01,000\r\nLast"


def test_subtitles(spark, tmp_path):
    (tmp_path / "a.srt").write_text(SRT, encoding="utf-8")
    got = [(r["start"], r["end"], r["text"]) for r in subtitles.read_srt(spark, str(tmp_path / "a.srt")).collect()]
    assert got == [(1.0, 2.5, "Hello\nthere"), (3600.0, 3601.0, "Last")]
    (tmp_path / "c.json").write_text('[{"start": 1.5, "end": 2, "text": "x"}]')
    assert [r["start"] for r in subtitles.read_cues(spark, str(tmp_path / "c.json")).collect()] == [1.5]


def test_cues_are_clipped(spark):
    m = Mapping(25.0, 0, 1000, 500)  # break at 40 s, 20 s are cut out
    rows = [(1, 1.0, 2.0, "in"), (2, 39.0, 45.0, "into the cut"), (3, 50.0, 70.0, "starts in the cut"), (4, 39.5, 61.0, "across"), (5, 61.0, 62.0, "after"), (6, 5048.0, 5060.0, "over the end")]
    got = {r["i"]: (round(r["start"], 6), round(r["end"], 6)) for r in cues.retimed(spark.createDataFrame(rows, "i long, start double, end double, text string"), m).collect()}
    assert got == {1: (1.0, 2.0), 2: (39.0, 40.0), 4: (39.5, 40.0), 5: (41.0, 42.0), 6: (5028.0, 5029.72)}
    one = spark.createDataFrame([(0, 2, 1.0, 2.5, "b"), (0, 1, 0.0, 0.5, "a")], "k int, i long, start double, end double, text string")
    r = cues.as_text(one, ["k"], "i").first()
    assert r["srt"] == "1\n00:00:00,000 --> 00:00:00,500\na\n\n2\n00:00:01,000 --> 00:00:02,500\nb\n"
    assert r["vtt"].startswith("WEBVTT\n\n00:00:00.000 --> 00:00:00.500\na\n")
    assert json.loads(r["json"])[1] == {"start": 1.0, "end": 2.5, "text": "b"}


def test_tracks(spark, tmp_path):
    spans = spark.createDataFrame([("b", 1, 3.00049, 4.0), ("a", 2, 1.0, 2.0), ("a", 1, 5.0, 6.0)], "label string, order long, a double, b double")
    body = json.loads(tracks.intervals(spans, "ann", "Annotations").first()["body"])
    assert body == {"labels": {"a": [[5.0, 6.0], [1.0, 2.0]], "b": [[3.0, 4.0]]}, "label_groups": {"Annotations": ["a", "b"]}}
    text = json.loads(tracks.text(spark.createDataFrame([(2.0, 3.0, "y"), (1.0, 2.0, "x")], "a double, b double, text string"), "t", "T").first()["body"])
    assert [s["text"] for s in text["segments"]] == ["x", "y"]
    values = spark.createDataFrame([(1, float("nan")), (0, 0.1), (2, None)], "i long, v double")
    assert json.loads(tracks.series(values, "s", "S", 0.0, 0.04).first()["body"])["values"] == [0.1, None, None]
    times = [(1, 2, 3.25), (1, 1, 7.5), (1, 1, -0.1), (1, 1, 1e-3), (1, 2, 123456.789), (1, 2, 0.0), (2, 9, 1e30)]
    spikes = spark.createDataFrame(times, "patient int, unit_id long, t double")
    data = {r["patient"]: r["data"] for r in tracks.spike_binary(spikes).collect()}
    want = [x for u in (1, 2) for x in sorted(t for p, uu, t in times if p == 1 and uu == u)]
    assert bytes(data[1]) == struct.pack(f"<{len(want)}f", *want)
    assert {(r["unit_id"], r["offset"], r["count"]) for r in tracks.spike_offsets(spikes).filter("patient = 1").collect()} == {(1, 0, 3), (2, 3, 3)}
    units = spark.createDataFrame([(1, 1, "A", "L", True, "x"), (1, 2, "B", "R", False, "y"), (1, 3, "B", "R", False, "y")], "patient int, unit_id long, region string, hemisphere string, single_unit boolean, cell_type string")
    track = tracks.spikes(units, spikes, "sp", "Spikes")
    assert [u["count"] for u in json.loads(track.first()["body"])["patients"][0]["units"]] == [3, 3, 0]
    tracks.write_tracks(track.unionByName(tracks.intervals(spans, "ann", "Annotations")), str(tmp_path / "tracks"))
    tracks.write_tracks(tracks.intervals(spans.filter("label = 'a'"), "ann", "Only a"), str(tmp_path / "tracks"))  # takes the place of the first
    assert [(r["id"], r["name"]) for r in tracks.manifest(spark, str(tmp_path / "tracks")).collect()] == [("ann", "Only a"), ("sp", "Spikes")]


def test_tracks_of_a_project(spark):
    flags = spark.createDataFrame([(p, 1 if 2 <= p < 5 else 2 if p == 9 else 0) for p in range(10)], "p long, flag smallint")
    body = json.loads(builders.alignment_track(flags, Mapping(25.0, 0, 7, 3)).first()["body"])
    assert body["labels"] == {"break": [[0.28, 0.32]], "maybe one frame off": [[0.08, 0.2]], "no picture": [[0.36, 0.4]]}
    calm = json.loads(builders.alignment_track(flags.filter("p < 2"), Mapping(25.0, 0, 7, 3)).first()["body"])
    assert calm["labels"]["no picture"] == []
    marks = spark.createDataFrame([("tom", 0, 1), ("hall", 0, 99), ("hall", 1, 1)], "label string, p long, v short")
    body = json.loads(builders.annotation_track(marks, {"People": ["tom"]}).first()["body"])
    assert body == {"labels": {"hall": [[0.04, 0.08]], "tom": [[0.0, 0.04]]}, "label_groups": {"People": ["tom"], "Locations": ["hall"]}}
    signal = spark.createDataFrame([(0, 0.5), (1, 2.0)], "i long, mad double")
    assert json.loads(builders.frame_change_track(signal, 2).first()["body"])["values"] == [0.5, 2.0]
    with pytest.raises(ValueError, match="2 frames"):
        builders.frame_change_track(signal, 3)


def test_viewport(spark):
    spans = spark.createDataFrame([("a", 0.0, 2.0), ("a", 2.0, 4.0), ("b", 1.0, 9.0)], "k string, x double, y double")
    assert {(r["k"], r["x"]) for r in viewport.current(spans, ["k"], "x", "y", 2.0).collect()} == {("a", 2.0), ("b", 1.0)}
    assert viewport.visible(spans, "x", "y", 3.0, 5.0).count() == 2
    samples = spark.createDataFrame([(0, 0.0, 5.0), (0, 0.5, -1.0), (0, 1.0, 7.0), (0, 1.5, float("nan"))], "k int, t double, v double")
    assert {(r["bin"], r["low"], r["high"]) for r in viewport.min_max(samples, ["k"], "t", "v", 0.0, 2.0, 2).collect()} == {(0, -1.0, 5.0), (1, 7.0, 7.0)}
    assert {(r["bin"], r["high"]) for r in viewport.min_max(samples, ["k"], "t", "v", 0.0, 2.0, 2, True).collect()} == {(0, 7.0), (1, 7.0)}
    units = spark.createDataFrame([(1, "B", 1, True), (1, "A", 2, False), (2, "A", 1, True)], "patient int, region string, unit_id long, single_unit boolean")
    assert [(r["patient"], r["unit_id"]) for r in viewport.unit_rows(units, True).orderBy("row").collect()] == [(1, 2), (2, 1), (1, 1)]
    assert viewport.unit_rows(units, False, patients=[1], single_only=True).count() == 1
    assert viewport.nearest_sample(0.13, 0.0, 0.04, 10) == 3 and viewport.nearest_sample(9.0, 0.0, 0.04, 10) is None


def test_steps_run_when_needed(spark, tmp_path):
    made, inputs, log = tmp_path / "out", {"x": 1}, []

    def make():
        made.write_text("x")
        log.append("a")

    runner = steps.Runner(spark, str(tmp_path / "stamps"), [steps.Step("a", lambda: dict(inputs), make, [str(made)]), steps.Step("b", dict, lambda: log.append("b"), needs=["a"])])
    assert runner.status() == {"a": "missing", "b": "missing"}
    assert runner.setup() == ["a", "b"] and runner.setup() == []
    inputs["x"] = 2
    assert runner.status() == {"a": "stale", "b": "ok"}
    assert runner.setup() == ["a", "b"] and log == ["a", "b", "a", "b"]  # b follows from a's stamp
    made.unlink()
    assert runner.status()["a"] == "missing" and runner.setup(skip={"a"}) == []
    assert runner.setup(force=True) == ["a", "b"]
    failing = steps.Runner(spark, str(tmp_path / "other"), [steps.Step("check", dict, lambda: False)])
    with pytest.raises(RuntimeError):
        failing.setup()
    assert failing.status() == {"check": "missing"}


def test_registry_and_files(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "fingerprint string, v int")
    assert {tuple(r) for r in steps.upserted(old, spark.createDataFrame([("b", 3), ("c", 4)], "fingerprint string, v int"), "fingerprint").collect()} == {("a", 1), ("b", 3), ("c", 4)}
    assert {r["fingerprint"]: r["v"] for r in steps.known_copies(spark.createDataFrame([("a",), ("z",)], "fingerprint string"), old).collect()} == {"a": 1, "z": None}
    pages = {"1": {"results": [{"path": "p", "asset_id": "i", "size": 5}], "next": "2"}, "2": {"results": [{"path": "q", "asset_id": "j", "size": 6}]}}
    wanted = assets.listed(spark, "1", pages.get, lambda i: i * 2)
    assert [r["path"] for r in steps.to_fetch(wanted, wanted.filter("path = 'p'")).collect()] == ["q"]
    assert tuple(steps.fetch_total(wanted).first()) == (2, 11)
    streams = spark.createDataFrame([(0, "en"), (1, "de"), (2, None)], "stream int, language string")
    pick = lambda df, *a: [r["stream"] for r in steps.chosen_stream(df, *a).collect()]
    assert pick(streams, "de") == [1] and pick(streams, "fr") == [] and pick(streams, "fr", 2) == [2]
    assert pick(streams.filter("stream = 2"), "de") == [2] and pick(streams.filter("stream = 2"), "en") == []
    sessions = spark.createDataFrame([("x/sub-10/a.nwb",), ("x/sub-9/a.nwb",), ("y",)], "path string")
    assert [r["patient"] for r in recordings.sessions(sessions).collect()] == [9, 10]
    assert steps.readiness(2, recordings.sessions(sessions), streams, "de", "v", "v")["ready"]


def test_configuration_and_ragged_columns(spark):
    got = config.parse('video = "v.mkv"\n[audio]\nde = "v.mkv#2"\nen = "e.mka"\n[subtitles]\nde = "s.srt"')
    assert got.audio["de"] == config.AudioSource("v.mkv", 2) and got.audio["en"].stream is None and got.data_dir == "data"
    data = spark.createDataFrame([(1, i, float(i)) for i in range(7)], "k int, pos long, value double")
    ends = spark.createDataFrame([(1, 1, 3), (1, 2, 3), (1, 3, 7)], "k int, unit long, end long")
    assert {r["pos"]: r["unit"] for r in recordings.ragged(data, ends, ["k"]).collect()} == {0: 1, 1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 6: 3}
    with pytest.raises(RuntimeError):
        recordings.needed("no_such_library")


def test_media_plans(spark):
    fm = spark.createDataFrame([(0, 0, 5, 0), (0, 1, 5, 1), (0, 2, 7, 0), (0, 3, 7, 2)], "recording int, p long, file_frame int, flag smallint")
    assert [r["action"] for r in media.picture_plan(fm).orderBy("p").collect()] == ["show", "repeat", "show", "black"]
    frames = spark.createDataFrame([(i,) for i in range(5, 8)], "i long")
    assert [r["i"] for r in media.dropped_frames(frames, fm).collect()] == [6]
    plan = {r["segment"]: r for r in media.sound_plan(spark, Mapping(24000 / 1001, 25, 97210, 11020)).collect()}
    assert plan[0]["n_samples"] == 97210 * 48000 // 25 and plan[0]["n_samples"] + plan[1]["n_samples"] == 125743 * 1920
    assert plan[0]["speed"] == pytest.approx(25 * 1001 / 24000)
    packets = spark.createDataFrame([(1, 5), (0, 5), (1, 2)], "stream int, dts long")
    assert [(r["stream"], r["dts"]) for r in media.mux_plan(packets.withColumn("seq", F.lit(0)).withColumn("size", F.lit(3))).orderBy("place").collect()] == [(1, 2), (0, 5), (1, 5)]
    picks = media.sheet_frames(spark.range(100).withColumnRenamed("id", "p"), 6, 10, 90)
    assert picks.count() == 6 and picks.agg(F.min("p")).first()[0] > 10
    assert "<td>&lt;x&gt;</td>" in media.report_html("t", [{"a": "<x>"}])


def test_stream_on_a_clock(spark, tmp_path):
    clock = spark.createDataFrame([(1, i, 0.04 * (i + 1), 40.0 * i + (10_000 if i >= 50 else 0)) for i in range(100)], "k int, i long, pts double, ms double")
    spark.createDataFrame([(1, t) for t in (0.0, 20.0, 1000.0, 5000.0, 12000.0, 13000.0, 13960.0, 99999.0)], "k int, t double").write.parquet(str(tmp_path / "in"))
    points = spark.readStream.schema("k int, t double").parquet(str(tmp_path / "in"))
    out = stream.interpolated_stream(points, clock, ["k"], "t", "ms", "pts", "i", 200.0, 1000.0)
    q = out.writeStream.format("memory").queryName("on_clock").outputMode("append").start()
    try:
        q.processAllAvailable()
        assert sorted(r["value"] for r in spark.table("on_clock").collect()) == pytest.approx([0.04, 0.06, 1.04, 2.04, 3.04, 4.0])
    finally:
        q.stop()


def test_tables_of_a_recording(spark):
    """Arrays by path stand for an HDF5 file."""
    f = {
        "processing/machine_learning/movie_annotations_indicator_functions": {
            "label_name": np.array([b"cut", b"face"]), "indicator_function": np.array([0, 1, 1, 99, 0], np.uint8), "indicator_function_index": np.array([3, 5], np.uint64)
        },
        "stimulus/presentation/cleaned_watchlogs": {"pts": np.array([0.0, 0.04, 0.04]), "neural_recording_time": np.array([5.0, 45.0, 85.0])},
    }
    got = pd.concat(recordings.nwb_tables(f, "annotations", 3))
    assert list(got.itertuples(index=False, name=None)) == [("cut", 0, 0), ("cut", 1, 1), ("cut", 2, 1), ("face", 0, 99), ("face", 1, 0)]
    got = pd.concat(recordings.nwb_tables(f, "watchlog", 3))
    assert list(got.itertuples(index=False, name=None)) == [(3, 0, 0.0, 5.0), (3, 1, 0.04, 45.0), (3, 2, 0.04, 85.0)]
    with pytest.raises(ValueError, match="no canonical table"):
        recordings.read_nwb(spark, "nowhere", "watchlogs")
    files = spark.createDataFrame([("/nwb/sub-10/a.nwb",), ("/nwb/sub-9/a.nwb",)], "path string")
    assert [r["path"] for r in recordings.first_session(files).collect()] == ["/nwb/sub-9/a.nwb"]


def test_frames_are_grabbed(spark):
    frames = spark.createDataFrame([("a", i, i / 25, [i]) for i in range(100)], "path string, i long, pts double, pixels array<int>")
    wanted = spark.createDataFrame([("a", 1.01, "x"), ("a", 0.06, "y"), ("a", 9.0, "late"), ("b", 1.0, "other")], "path string, t double, why string")
    got = {r["why"]: (r["frame"]["i"] if r["frame"] else None, r["error"]) for r in recordings.grabbed(frames, wanted, 0.5).collect()}
    assert got == {"x": (25, None), "y": (1, None), "late": (None, "no frame within 0.5 s"), "other": (None, "no frames")}
    chunks = spark.createDataFrame([("a", 0, 3, [0.5, 0.25])], "path string, channel int, first long, x array<double>")
    assert [(r["n"], r["x"]) for r in recordings.samples(chunks).collect()] == [(3, 0.5), (4, 0.25)]
