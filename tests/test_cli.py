import json

from pyspark.sql import functions as F

from framelark import cli
from framelark.functions.axis import IDENTITY, Mapping
from framelark.plans.project import Project


def test_subtitles_and_manifest(spark, tmp_path, capsys):
    (tmp_path / "a.srt").write_text("1\n00:00:01,000 --> 00:00:02,000\nHi\n")
    cli.main(["subs", str(tmp_path / "a.srt"), str(tmp_path / "out")])
    assert json.loads(capsys.readouterr().out) == {"files": 1}
    assert "00:00:01,000 --> 00:00:02,000\nHi" in spark.read.parquet(str(tmp_path / "out")).first()["srt"]
    (tmp_path / "tracks").mkdir()
    (tmp_path / "tracks" / "t.json").write_text('{"id": "x", "name": "X", "type": "text", "body": "{}"}\n')
    cli.main(["manifest", str(tmp_path / "tracks")])
    assert json.loads(capsys.readouterr().out)[0]["id"] == "x"
    assert cli.parser().parse_args(["align", "f", "s", "o"]).titles


def test_setup_runs_what_is_out_of_date(spark, tmp_path, capsys):
    folder, out = str(tmp_path / "canonical"), str(tmp_path / "out")
    marks = spark.range(60).select(F.lit("face").alias("label"), F.col("id").alias("p"), F.col("id").between(10, 19).cast("short").alias("v"))
    marks.write.parquet(f"{folder}/annotations")
    clock = [(1, i, 0.04 * (i + 1), 40.0 * i + (10_000 if i >= 50 else 0)) for i in range(100)]
    spark.createDataFrame(clock, "patient int, i long, pts double, neural_ms double").write.parquet(f"{folder}/watchlog")
    spark.createDataFrame([(1, 1, 0.0), (1, 1, 20.0), (1, 1, 5000.0), (1, 2, 13000.0)], "patient int, unit_id long, t_ms double").write.parquet(f"{folder}/spikes")
    units = [(1, 1, "A", "L", True, "x"), (1, 2, "A", "L", True, "x"), (1, 3, "A", "R", False, "y")]
    spark.createDataFrame(units, "patient int, unit_id long, brain_region string, hemisphere string, is_single_unit boolean, cell_type string").write.parquet(f"{folder}/units")
    srt = tmp_path / "a.srt"
    srt.write_text("1\n00:00:01,000 --> 00:00:02,000\nHi\n")

    def ran(*arguments):
        cli.main([*arguments, folder, out, "--subtitles", f"de={srt}"])
        return json.loads(capsys.readouterr().out)

    assert ran("status") == {"subs": "missing", "tracks": "missing"}
    assert ran("setup") == {"ran": ["subs", "tracks"]} and ran("setup") == {"ran": []}
    srt.write_text("1\n00:00:01,000 --> 00:00:02,000\nHi there\n")
    assert ran("status") == {"subs": "stale", "tracks": "ok"}
    assert ran("setup") == {"ran": ["subs", "tracks"]} and ran("status") == {"subs": "ok", "tracks": "ok"}
    assert ran("run", "tracks") == {"ran": ["tracks"]}
    cli.main(["manifest", f"{out}/tracks"])
    assert [t["id"] for t in json.loads(capsys.readouterr().out)] == ["annotations", "spikes", "subs_de"]
    bodies = {r["id"]: json.loads(r["body"]) for r in spark.read.json(f"{out}/tracks").collect()}
    assert bodies["annotations"]["labels"] == {"face": [[0.4, 0.8]]} and bodies["subs_de"]["segments"][0]["text"] == "Hi there"
    assert [u["count"] for u in bodies["spikes"]["patients"][0]["units"]] == [2, 1, 0]


def test_copies_are_registered(spark, tmp_path, capsys):
    own = Project(spark, "", str(tmp_path / "out"))
    own.store("mapping", {"mapping": Mapping(25.0, 1, 100, 7).to_dict()})
    for description in ("first", "second"):
        cli.main(["register-copy", str(tmp_path / "out"), str(tmp_path / "registry"), "abc", description])
        (row,) = json.loads(capsys.readouterr().out)
        assert (row["description"], json.loads(row["mapping"])["gap"]) == (description, 7)
    assert own.mapping() == Mapping(25.0, 1, 100, 7) and Project(spark, "", str(tmp_path / "none")).mapping() == IDENTITY


def test_what_is_to_be_fetched(spark, tmp_path, capsys):
    files = [("a", 3, "x"), ("b", 5, "y"), ("c", 7, "z")]
    spark.createDataFrame(files, "path string, size long, sha256 string").write.parquet(str(tmp_path / "wanted"))
    spark.createDataFrame([("a", 3, "x"), ("b", 4, "y")], "path string, size long, sha256 string").write.parquet(str(tmp_path / "present"))
    cli.main(["to-fetch", str(tmp_path / "wanted"), str(tmp_path / "present"), str(tmp_path / "missing")])
    assert json.loads(capsys.readouterr().out) == {"files": 2, "bytes": 12}
    assert {r["path"] for r in spark.read.parquet(str(tmp_path / "missing")).collect()} == {"b", "c"}
