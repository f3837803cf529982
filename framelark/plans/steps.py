"""Incremental runs: a step runs again when its inputs' signature has changed or its outputs are gone."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark.sources import versions


def signature(parts: dict) -> str:
    return json.dumps(parts, sort_keys=True, separators=(",", ":"), default=str)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException:
        return False
    return True


@dataclass
class Step:
    """inputs gives what the outputs follow from; run makes them; outputs are paths; needs are steps whose stamps count as inputs."""

    name: str
    inputs: Callable[[], dict]
    run: Callable[[], bool | None]
    outputs: list[str] = field(default_factory=list)
    needs: list[str] = field(default_factory=list)


_STAMP = "step string, signature string"


class Runner:
    """Steps in order, with their stamps in a table (step, signature) in a folder that Spark can write to."""

    def __init__(self, spark: SparkSession, folder: str, steps: list[Step]):
        self.spark, self.folder, self.steps = spark, folder, steps

    def stamp(self, step: Step) -> str | None:
        row = versions.read(self.spark, f"{self.folder}/{step.name}", _STAMP).first()
        return row["signature"] if row else None

    def write_stamp(self, step: Step, value: str) -> None:
        versions.write(self.spark.createDataFrame([(step.name, value)], _STAMP).coalesce(1), f"{self.folder}/{step.name}")

    def now(self, step: Step) -> str:
        by_name = {s.name: s for s in self.steps}
        return signature({"inputs": step.inputs(), "needs": {n: self.stamp(by_name[n]) for n in step.needs}})

    def state(self, step: Step) -> str:
        old = self.stamp(step)
        if old is None or not all(exists(self.spark, p) for p in step.outputs):
            return "missing"
        return "ok" if old == self.now(step) else "stale"

    def status(self) -> dict[str, str]:
        return {s.name: self.state(s) for s in self.steps}

    def run(self, name: str) -> None:
        """Runs one step, whatever its state."""
        step = next(s for s in self.steps if s.name == name)
        if step.run() is False:
            raise RuntimeError(f"{step.name} did not pass")
        self.write_stamp(step, self.now(step))

    def setup(self, skip: set[str] = frozenset(), force: bool = False) -> list[str]:
        """Runs what isn't ok, in order; a step that returns False stops the run without a stamp. Signatures are taken anew for each
        step, as those before it may have changed them."""
        ran = []
        for step in self.steps:
            if step.name in skip or (not force and self.state(step) == "ok"):
                continue
            self.run(step.name)
            ran.append(step.name)
        return ran


def states(steps: DataFrame) -> DataFrame:
    """The same decision on a table (step, stamp, signature, present): state ok, stale or missing."""
    state = F.when(F.col("stamp").isNull() | ~F.col("present"), "missing").when(F.col("stamp") == F.col("signature"), "ok").otherwise("stale")
    return steps.select("step", state.alias("state"))


def merged_maps(a: Column, b: Column) -> Column:
    """Both maps in one; where both have a key b's value counts."""
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)


def file_signature(spark: SparkSession, path: str) -> list:
    """Number and bytes of a table's files, the last time of change and a hash over all of them, to tell whether it has changed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.col("modificationTime").cast("long").alias("t"))
    each = F.xxhash64("path", "length", "t")
    return list(files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.max("t"), F.coalesce(F.bit_xor(each), F.lit(0))).first())


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with the rows of new in place of those with the same key."""
    return old.join(new.select(key), key, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def to_fetch(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Files that aren't there with the wanted size and digest."""
    return wanted.join(present.select("path", "size", "sha256"), ["path", "size", "sha256"], "left_anti").select(*wanted.columns)


def fetch_total(wanted: DataFrame) -> DataFrame:
    return wanted.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def known_copies(files: DataFrame, registry: DataFrame) -> DataFrame:
    """files with what is registered under their fingerprint, null if nothing is."""
    return files.join(registry, "fingerprint", "left")


def readiness(wanted_sessions: int, sessions: DataFrame, streams: DataFrame, language: str, video: str, audio: str) -> dict:
    """Whether inputs are complete: sessions, an audio stream of the language, audio of the same recording as the video."""
    n = sessions.select("patient").distinct().count()
    chosen = chosen_stream(streams, language).first()
    out = {"sessions": n == wanted_sessions, "audio_stream": None if chosen is None else chosen["stream"], "same_recording": video == audio}
    return out | {"ready": bool(out["sessions"] and out["audio_stream"] is not None and out["same_recording"])}


def chosen_stream(streams: DataFrame, language: str, explicit: int | None = None, default: str = "de") -> DataFrame:
    """Of streams (stream, language) of a file: the explicit one; else the one with the language; else the only one, if the
    language is the default. No row if that leaves none or several."""
    if explicit is not None:
        return streams.filter(F.col("stream") == explicit)
    counts = streams.agg(F.count(F.lit(1)).alias("_all"), F.count_if(F.col("language") == language).alias("_tagged"))
    rows = streams.crossJoin(F.broadcast(counts))  # one row of counts
    tagged = (F.col("language") == language) & (F.col("_tagged") == 1)
    alone = (F.col("_all") == 1) & F.lit(language == default)
    return rows.filter(tagged | ((F.col("_tagged") == 0) & alone)).select(*streams.columns)
