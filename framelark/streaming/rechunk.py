"""A stream of samples in chunks of any length becomes one of chunks of one length; what is left over is carried in state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from framelark.operators.stretches import running

#: The state store that keeps a value for each key; a session has to be set to it before the stream starts.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def cut(tail: np.ndarray, chunks: list[np.ndarray], size: int, flush: bool) -> tuple[list[np.ndarray], np.ndarray]:
    """tail and chunks in a row as chunks of size, and what is left; with flush the rest is a shorter chunk, and nothing is left."""
    every = np.concatenate([tail, *chunks])
    n = len(every) if flush else len(every) - len(every) % size
    return [every[a : min(a + size, n)] for a in range(0, n, size)], every[n:]


class Rechunker(StatefulProcessor):
    """For each key: the number of the next chunk, the next seq that is awaited, the tail, and chunks that came too early."""

    def __init__(self, keys: list[str], size: int):
        self.keys, self.size = keys, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "number long, awaited long, tail array<double>")
        self.early = handle.getMapState("early", "seq long", "x array<double>, last boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        number, awaited, tail = self.kept.get() if self.kept.exists() else (0, 0, [])
        tail = np.asarray(tail, np.float64)
        come = {}
        for batch in rows:
            for seq, x, last in zip(batch["seq"], batch["x"], batch["last"], strict=True):
                if seq >= awaited:  # what was taken already comes again after a failure of the source
                    come.setdefault(int(seq), (np.asarray([] if x is None else x, np.float64), bool(last)))
        chunks, ended = [], False
        while not ended:
            if awaited in come:
                x, ended = come.pop(awaited)
            elif self.early.containsKey((awaited,)):
                x, ended = self.early.getValue((awaited,))
                x = np.asarray(x, np.float64)
                self.early.removeKey((awaited,))
            else:
                break
            chunks.append(x)
            awaited += 1
        for seq, (x, last) in come.items():
            if not ended and not self.early.containsKey((seq,)):
                self.early.updateValue((seq,), (x.tolist(), last))
        made, tail = cut(tail, chunks, self.size, ended)
        self.kept.update((number + len(made), awaited, tail.tolist()))
        if made:
            out = pd.DataFrame({"number": range(number, number + len(made)), "x": [m.tolist() for m in made]})
            for name, value in zip(self.keys, key, strict=True):
                out[name] = value
            yield out[[*self.keys, "number", "x"]]

    def close(self) -> None:
        pass


def rechunked(chunks: DataFrame, keys: list[str], size: int) -> DataFrame:
    """(keys, number, x): of each key chunks of `size` samples in order, from a stream (keys, seq, x, last).

    seq counts a key's chunks from 0. Chunks may arrive in any order and more than once; those that are early wait in state
    until the ones before are there. A chunk marked last ends its key: the rest comes out as a shorter chunk, and what has a
    later seq is ignored. State is a tail shorter than `size` and the early chunks, for each key. It is kept by the stream's
    checkpoint, from which a restarted query goes on."""
    fields = [*(chunks.schema[k] for k in keys), *T.StructType.fromDDL("number long, x array<double>").fields]
    rows = chunks.select(*keys, F.col("seq").cast("long").alias("seq"), F.col("x").cast("array<double>").alias("x"), F.coalesce("last", F.lit(False)).alias("last"))
    return rows.groupBy(*keys).transformWithStateInPandas(Rechunker(keys, size), T.StructType(fields), "Append", "None")


def rechunked_batch(chunks: DataFrame, keys: list[str], size: int) -> DataFrame:
    """What rechunked() gives of a whole table whose chunks are all there, by positions: each chunk's part of each new chunk is
    cut out where it lies and dealt to it."""
    once = chunks.groupBy(*keys, "seq").agg(F.first("x").cast("array<double>").alias("x"), F.bool_or(F.coalesce("last", F.lit(False))).alias("last"))
    stops = once.groupBy(*keys).agg(F.min(F.when(F.col("last"), F.col("seq"))).alias("_stop"))
    own = once.join(stops, keys).filter(F.coalesce(F.col("seq") <= F.col("_stop"), F.lit(True)))
    own = own.withColumns({"x": F.coalesce("x", F.array().cast("array<double>")), "_n": F.coalesce(F.size("x"), F.lit(0)).cast("long")})
    placed = running(own, keys, "seq", "_n", "_upto").withColumn("_at", F.col("_upto") - F.col("_n"))
    ends = placed.groupBy(*keys).agg(F.max("_upto").alias("_end"), F.bool_or("last").alias("_ended"))
    parts = placed.filter("_n > 0").withColumn("number", F.explode(F.sequence(F.floor(F.col("_at") / size), F.floor((F.col("_at") + F.col("_n") - 1) / size))))
    begin = F.greatest(F.col("number") * size - F.col("_at"), F.lit(0))
    stop = F.least((F.col("number") + 1) * size - F.col("_at"), F.col("_n"))
    parts = parts.select(*keys, "number", F.struct("seq", F.slice("x", (begin + 1).cast("int"), (stop - begin).cast("int")).alias("v")).alias("p"))
    joined = parts.groupBy(*keys, "number").agg(F.flatten(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["v"])).alias("x"))
    return joined.join(ends, keys).filter(((F.col("number") + 1) * size <= F.col("_end")) | F.col("_ended")).select(*keys, "number", "x")
