"""Commands over the canonical tables: python -m framelark.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from framelark.functions.axis import IDENTITY, Mapping
from framelark.plans import checks, cues, steps, tracks
from framelark.plans.project import Project, registered
from framelark.sources import recordings, subtitles


def project(spark: SparkSession, a: argparse.Namespace) -> Project:
    return Project(spark, a.folder, a.out, a.signal, dict(x.split("=", 1) for x in a.subtitles), (a.cuts, a.scenes, a.titles))


def setup(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Runs every step that is missing or out of date: align, verify, subs, tracks."""
    return {"ran": project(spark, a).runner().setup(force=a.force)}


def status(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Tells which steps are ok, stale or missing."""
    return project(spark, a).runner().status()


def run_step(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Runs one step."""
    project(spark, a).runner().run(a.step)
    return {"ran": [a.step]}


def align(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Finds the mapping of a signal (i, pts, mad) and writes it with its frame map."""
    own = Project(spark, a.folder, a.out, a.signal, labels=(a.cuts, a.scenes, a.titles))
    own.align()
    return own.document("mapping")


def mapping_of(spark: SparkSession, path: str | None) -> Mapping:
    return Project(spark, "", path).mapping() if path else IDENTITY


def verify(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Checks a mapping, or with none that the signal lies on the axis itself."""
    own = Project(spark, a.folder, a.mapping or "", a.signal)
    return checks.check_cuts(mapping_of(spark, a.mapping), own.frames(), own.onsets(a.cuts), own.onsets(a.titles))


def register_copy(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    """Puts the mapping of a project, under a file's fingerprint, into a registry of known copies."""
    own = Project(spark, "", a.out)
    return [r.asDict() for r in registered(spark, a.registry, a.fingerprint, a.description, own.document("mapping"), own.document("verification")).collect()]


def subs(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Moves SubRip files to the axis; writes one row with srt, vtt and json for each."""
    rows = cues.retimed(subtitles.read_srt(spark, a.files), mapping_of(spark, a.mapping))
    out = cues.as_text(rows.withColumn("order", F.col("start")), ["file"], "order")
    out.write.mode("overwrite").parquet(a.out)
    return {"files": spark.read.parquet(a.out).count()}


def manifest(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    return [r.asDict() for r in tracks.manifest(spark, a.tracks).collect()]


def to_fetch(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Which of the wanted files (a table path, size, sha256) aren't there; writes them to out and tells how many bytes they have."""
    missing = steps.to_fetch(spark.read.parquet(a.wanted), spark.read.parquet(a.present))
    missing.write.mode("overwrite").parquet(a.out)
    return steps.fetch_total(spark.read.parquet(a.out)).first().asDict()


def probe(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    return [r.asDict() for r in recordings.probe_media(spark, a.files).collect()]


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="framelark")
    commands = out.add_subparsers(required=True)
    labels = (("--cuts", "cuts"), ("--scenes", "scenes"), ("--titles", "titles"))

    def command(name, run, *arguments, labelled=False):
        c = commands.add_parser(name, help=run.__doc__)
        for x in arguments:
            c.add_argument(x)
        for x, default in labels if labelled else ():
            c.add_argument(x, default=default)
        c.set_defaults(run=run)
        return c

    for name, run in (("setup", setup), ("status", status), ("run", run_step)):
        c = command(name, run, *(["step"] if name == "run" else []), "folder", "out", "--signal", labelled=True)
        c.add_argument("--subtitles", action="append", default=[], metavar="LANGUAGE=FILES")
        if name == "setup":
            c.add_argument("--force", action="store_true")
    command("register-copy", register_copy, "out", "registry", "fingerprint", "description")
    command("align", align, "folder", "signal", "out", labelled=True)
    command("verify", verify, "folder", "signal", "--mapping", labelled=True)
    command("subs", subs, "files", "out", "--mapping")
    command("manifest", manifest, "tracks")
    command("to-fetch", to_fetch, "wanted", "present", "out")
    command("probe", probe, "files")
    return out


def main(arguments: list[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("framelark").getOrCreate()
    print(json.dumps(a.run(spark, a), indent=1))


if __name__ == "__main__":
    main()
