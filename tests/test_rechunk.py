"""Chunks of a stream carried over from micro-batch to micro-batch."""

import random

import numpy as np
import pytest

from framelark.streaming import rechunk

SCHEMA = "k string, seq long, x array<double>, last boolean"


def rows_of(rng, ended=True):
    rows = {}
    for k, n in (("a", 230), ("b", 64), ("c", 0), ("d", 7)):
        x, at, seq = [float(i) for i in range(n)], 0, 0
        while at < n or seq == 0:
            size = rng.choice([0, 1, 3, 20, 70])
            rows.setdefault(k, []).append((k, seq, x[at : at + size], False))
            at, seq = at + size, seq + 1
        last = rows[k][-1]
        rows[k][-1] = (*last[:3], ended and k != "d")
    return rows


def plain(rows, size):
    out = {}
    for k, own in rows.items():
        x = [v for _, _, part, _ in own for v in part]
        n = len(x) if own[-1][3] else len(x) - len(x) % size
        for i in range(0, n, size):
            out[k, i // size] = x[i : min(i + size, n)]
    return out


@pytest.mark.parametrize("size", [1, 16, 64, 500])
def test_batch(spark, size):
    rows = rows_of(random.Random(size))
    df = spark.createDataFrame([r for own in rows.values() for r in own for _ in range(2)], SCHEMA).repartition(3)
    got = {(r["k"], r["number"]): r["x"] for r in rechunk.rechunked_batch(df, ["k"], size).collect()}
    assert got == plain(rows, size)


def test_cut():
    made, left = rechunk.cut(np.arange(3.0), [np.arange(4.0), np.arange(2.0)], 4, False)
    assert [m.tolist() for m in made] == [[0, 1, 2, 0], [1, 2, 3, 0]] and left.tolist() == [1]
    assert [m.tolist() for m in rechunk.cut(np.arange(3.0), [], 4, True)[0]] == [[0, 1, 2]]


@pytest.mark.parametrize("files", [1, 4])
def test_micro_batches_and_restart(spark, tmp_path, files):
    """Whatever the micro-batches, in any order and with repeats, and with the query stopped and started again between them."""
    rng = random.Random(files)
    rows = rows_of(rng)
    all_ = [r for own in rows.values() for r in own]
    rng.shuffle(all_)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", rechunk.PROVIDER)
    try:
        step = -(-len(all_) // files)
        for i in range(0, len(all_), step):
            again = rng.sample(all_[:i], min(i, 3))
            spark.createDataFrame(all_[i : i + step] + again, SCHEMA).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
            query = rechunk.rechunked(stream, ["k"], 16).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
            assert query.awaitTermination(240)
        got = [((r["k"], r["number"]), r["x"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
        assert dict(got) == plain(rows, 16) and len(got) == len(plain(rows, 16))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
