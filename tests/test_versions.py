"""A write that is killed leaves the version before."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from framelark.plans.project import Project, registered
from framelark.sources import versions

SCHEMA = "id long, v string"


def rows(spark, path):
    return sorted(tuple(r) for r in versions.read(spark, path, SCHEMA).collect())


@pytest.mark.parametrize("killed", ["parquet", "json"])
def test_killed_writes(spark, tmp_path, monkeypatch, killed):
    """Killed while the version is written, or when it stands but the pointer doesn't."""
    path = str(tmp_path / "t")
    assert rows(spark, path) == [] and versions.current(spark, path) is None
    versions.write(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), path)
    plain = getattr(DataFrameWriter, killed)

    def kill(self, *a, **b):
        if killed == "parquet":
            plain(self, *a, **b)  # files are there, but it fails before it is done
        raise KeyboardInterrupt

    monkeypatch.setattr(DataFrameWriter, killed, kill)
    with pytest.raises(KeyboardInterrupt):
        versions.write(versions.read(spark, path, SCHEMA).withColumn("v", F.lit("new")), path)
    monkeypatch.undo()
    assert rows(spark, path) == [(1, "a"), (2, "b")]
    versions.write(versions.read(spark, path, SCHEMA).filter("id = 2"), path)  # from itself
    assert rows(spark, path) == [(2, "b")] and versions.current(spark, path)[0] == 1


def test_old_versions_are_freed(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        versions.write(spark.createDataFrame([(i, "x")], SCHEMA), path)
    before = versions.read(spark, path, SCHEMA)
    assert versions.pruned(spark, path) == 2 and rows(spark, path) == [(3, "x")] and before.count() == 1
    assert sum(f.stat().st_size > 1000 or 0 for f in (tmp_path / "t" / "versions").rglob("*.parquet")) <= 4


def test_registry_survives_a_killed_write(spark, tmp_path, monkeypatch):
    registry, own = str(tmp_path / "registry"), Project(spark, "", str(tmp_path / "out"))
    document = {"mapping": {"head": 1}}
    assert registered(spark, registry, "a", "first", document, None).count() == 1
    own.store("mapping", document)
    monkeypatch.setattr(DataFrameWriter, "json", lambda *a, **b: (_ for _ in ()).throw(KeyboardInterrupt()))
    for write in (lambda: registered(spark, registry, "a", "second", document, None), lambda: own.store("mapping", {})):
        with pytest.raises(KeyboardInterrupt):
            write()
    monkeypatch.undo()
    assert own.document("mapping") == document
    got = registered(spark, registry, "b", "third", document, None).collect()
    assert sorted((r["fingerprint"], r["description"]) for r in got) == [("a", "first"), ("b", "third")]
