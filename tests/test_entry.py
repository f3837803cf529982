"""All registered queries have SQL that gives the same rows, as far as SQL can; here on the smallest tables."""

import importlib
import math
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from framelark.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted(repr([clean(r[i]) for i in order]) for r in values)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_same_rows_as_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["bin", "n"] and df.count() > 0


def test_without_the_text_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith(("framelark.llm", "corpus_pipeline", "__spark_entry__"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "framelark.llm.queries", None)  # imports of it fail as if it weren't there
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.queries()) == set(registry.queries()) == set(entry.oracle_sql())
