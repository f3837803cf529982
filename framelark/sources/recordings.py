"""Recordings: canonical tables, ragged columns, sessions; and readers of binary formats, which need libraries of their own.

The canonical form is Parquet: annotations (label, p, v), watchlog (patient, i, pts, neural_ms), units (patient, unit_id,
brain_region, hemisphere, is_single_unit, cell_type) and spikes (patient, unit_id, t_ms), the last three partitioned by patient."""

from __future__ import annotations

import importlib
import itertools
from collections.abc import Iterable, Iterator, Mapping
from types import ModuleType

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "annotations": "label string, p long, v short",
    "watchlog": "patient int, i long, pts double, neural_ms double",
    "units": "patient int, unit_id long, brain_region string, hemisphere string, is_single_unit boolean, cell_type string",
    "spikes": "patient int, unit_id long, t_ms double",
}


def needed(library: str) -> ModuleType:
    try:
        return importlib.import_module(library)
    except ImportError as e:
        raise RuntimeError(f"{library} is not installed; read the canonical Parquet tables instead") from e


def canonical(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}")


def sessions(files: DataFrame) -> DataFrame:
    """Patients, as numbers in order, from paths with a folder sub-<n>."""
    number = F.regexp_extract("path", r"sub-(\d+)", 1)
    return files.filter(number != "").select(number.cast("int").alias("patient")).distinct().orderBy("patient")


def ragged(data: DataFrame, ends: DataFrame, keys: list[str]) -> DataFrame:
    """data (keys, pos, value) with the unit each position belongs to; ends (keys, unit, end) are cumulative: a unit's values
    stand from the end of the one before. A unit without values has none."""
    from framelark.operators.asof import around

    starts = ends.select(*keys, F.col("end").alias("upto"), F.col("unit").cast("long").alias("unit"))
    # the first end above pos: ends up to pos lie before, the next row follows
    found = around(data, starts, keys, "pos", "upto", "unit")
    return found.select(*keys, F.col("after.unit").alias("unit"), "pos", "value")


def _text(values: Iterable) -> list[str]:
    return [v.decode() if isinstance(v, bytes) else str(v) for v in values]


def nwb_tables(f: Mapping, table: str, patient: int) -> Iterator[pd.DataFrame]:
    """The rows of a canonical table in one open recording f, which gives groups and arrays by their paths."""
    if table == "annotations":
        group = f["processing/machine_learning/movie_annotations_indicator_functions"]
        values, ends = group["indicator_function"][:], group["indicator_function_index"][:].tolist()
        for label, a, b in zip(_text(group["label_name"][:]), [0, *ends[:-1]], ends, strict=True):
            yield pd.DataFrame({"label": label, "p": range(b - a), "v": values[a:b].astype("int16")})
    elif table == "watchlog":
        group = f["stimulus/presentation/cleaned_watchlogs"]
        pts, ms = group["pts"][:].astype(float), group["neural_recording_time"][:].astype(float)
        yield pd.DataFrame({"patient": patient, "i": range(len(pts)), "pts": pts, "neural_ms": ms})
    elif table == "units":
        units = f["units"]
        yield pd.DataFrame({"patient": patient, "unit_id": units["id"][:], **{c: _text(units[c][:]) for c in ("brain_region", "hemisphere", "cell_type")}, "is_single_unit": units["is_single_unit"][:].astype(bool)})
    elif table == "spikes":
        units = f["units"]
        ends, times = units["spike_times_index"][:], units["spike_times"][:]
        for unit, a, b in zip(units["id"][:], [0, *ends[:-1]], ends, strict=True):
            yield pd.DataFrame({"patient": patient, "unit_id": unit, "t_ms": times[a:b]})
    else:
        raise ValueError(f"no canonical table {table}")


def first_session(files: DataFrame) -> DataFrame:
    """The files of the patient with the smallest number; all files if no path has a number."""
    first = sessions(files).first()
    return files if first is None else files.filter(F.regexp_extract("path", r"sub-(\d+)", 1).cast("int") == first["patient"])


def read_nwb(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A canonical table from HDF5 recordings, one task for each file. Annotations are the same in every patient's file and
    come from the first patient's. Needs h5py; not run where that is missing."""
    if table not in SCHEMAS:
        raise ValueError(f"no canonical table {table}; there are {', '.join(SCHEMAS)}")
    needed("h5py")
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    if table == "annotations":
        files = first_session(files)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import re

        import h5py

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                found = re.search(r"sub-(\d+)", name)
                with h5py.File(io.BytesIO(content)) as f:
                    yield from nwb_tables(f, table, int(found[1]) if found else -1)

    return files.mapInPandas(rows, SCHEMAS[table])


def probe_media(spark: SparkSession, path: str) -> DataFrame:
    """(path, codec, width, height, rate, frames, audio languages) of media files. Needs PyAV; not run where that is missing."""
    needed("av")
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import av

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with av.open(io.BytesIO(content)) as media:
                    v = media.streams.video[0]
                    languages = [a.metadata.get("language", "") for a in media.streams.audio]
                    yield pd.DataFrame([{"path": name, "codec": v.codec_context.name, "width": v.width, "height": v.height, "rate": float(v.average_rate), "frames": v.frames, "languages": languages}])

    return files.mapInPandas(rows, "path string, codec string, width int, height int, rate double, frames long, languages array<string>")


def media_frames(spark: SparkSession, path: str, width: int = 96, height: int = 40) -> DataFrame:
    """(path, i, pts, pixels) of every video frame, grey and small, for signal.frame_signal. Needs PyAV; not run without it."""
    needed("av")
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import av

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with av.open(io.BytesIO(content)) as media:
                    for i, frame in enumerate(media.decode(video=0)):
                        grey = frame.reformat(width, height, "gray").to_ndarray().astype("int16").ravel().tolist()
                        yield pd.DataFrame([{"path": name, "i": i, "pts": float(frame.time), "pixels": grey}])

    return files.mapInPandas(rows, "path string, i long, pts double, pixels array<short>")


def nearest_frames(frames: DataFrame, wanted: DataFrame) -> DataFrame:
    """Frames (i, pts, ...) that are wanted (i): random access as an equality join on the decoded table."""
    return frames.join(wanted.select("i").distinct(), "i", "left_semi")


def grabbed(frames: DataFrame, wanted: DataFrame, tolerance: float, bucket: float = 600.0) -> DataFrame:
    """wanted (path, t and more) with `frame`, a struct of the frame of that file (path, i, pts, ...) that is nearest in time, and
    `error`: null, or why there is none: the file has no frames, or none within tolerance seconds (frame is null then)."""
    from framelark.operators.asof import nearest

    found = nearest(wanted, frames, ["path"], "t", "pts", "i", bucket)
    far = F.abs(F.col("near.pts") - F.col("t")) > tolerance
    error = F.when(F.col("near").isNull(), "no frames").when(far, F.concat(F.lit("no frame within "), F.lit(str(tolerance)), F.lit(" s")))
    return found.withColumn("error", error).withColumn("frame", F.when(error.isNull(), F.col("near"))).drop("near")


def media_samples(spark: SparkSession, path: str, stream: int = 0, rate: int = 16_000) -> DataFrame:
    """(path, channel, first, x) of an audio stream of media files, resampled: arrays of samples with the number of their first one.
    Needs PyAV; not run where that is missing."""
    needed("av")
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import av

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with av.open(io.BytesIO(content)) as media:
                    resampler, first = av.AudioResampler(format="fltp", rate=rate), 0
                    for frame in itertools.chain(media.decode(audio=stream), [None]):
                        for part in resampler.resample(frame):
                            x = part.to_ndarray()
                            yield pd.DataFrame([{"path": name, "channel": c, "first": first, "x": row.astype(float).tolist()} for c, row in enumerate(x)])
                            first += x.shape[1]

    return files.mapInPandas(rows, "path string, channel int, first long, x array<double>")


def samples(chunks: DataFrame) -> DataFrame:
    """(path, channel, n, x): a row for each sample of media_samples()."""
    return chunks.select("path", "channel", "first", F.posexplode("x").alias("at", "x")).select("path", "channel", (F.col("first") + F.col("at")).alias("n"), "x")
