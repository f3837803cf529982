"""The steps from a recording's signal, annotations and subtitles to a checked mapping, moved cues and viewer tracks. Each runs
again when what it is made from has changed, and none runs on a mapping that failed its check."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark.functions.axis import IDENTITY, Mapping
from framelark.operators import runs
from framelark.plans import builders, checks, cues, steps, tracks
from framelark.plans.fit import fit, frame_map
from framelark.sources import recordings, subtitles, versions


@dataclass(frozen=True)
class Project:
    """folder holds the canonical tables, signal is the table (i, pts, mad) of a recording (none: it lies on the axis itself),
    subtitles are SubRip files by language, out is where results go."""

    spark: SparkSession
    folder: str
    out: str
    signal: str | None = None
    subtitles: dict[str, str] = field(default_factory=dict)
    labels: tuple[str, str, str] = ("cuts", "scenes", "titles")

    def onsets(self, label: str) -> DataFrame:
        rows = recordings.canonical(self.spark, self.folder, "annotations").filter(F.col("label") == label)
        return runs.rising(rows, ["label"], "p", runs.is_on(F.col("v"))).select("p")

    def frames(self) -> DataFrame:
        return self.spark.read.parquet(self.signal)

    def document(self, name: str) -> dict | None:
        """A document that a step has stored."""
        row = versions.read(self.spark, f"{self.out}/{name}", "value string").first()
        return None if row is None else json.loads(row["value"])

    def store(self, name: str, value: dict) -> None:
        """Puts a document in place of an older one, at once: a run that is ended meanwhile leaves the older one."""
        row = self.spark.createDataFrame([(json.dumps(value, default=str),)], "value string")
        versions.write(row.coalesce(1), f"{self.out}/{name}")

    def mapping(self) -> Mapping:
        stored = self.document("mapping")
        return Mapping(**stored["mapping"]) if stored else IDENTITY

    def align(self) -> None:
        cuts, scenes, titles = map(self.onsets, self.labels)
        mapping, found = fit(self.frames(), cuts, scenes.unionByName(titles))
        frame_map(mapping, self.frames()).write.mode("overwrite").parquet(f"{self.out}/frame_map")
        flags = self.spark.read.parquet(f"{self.out}/frame_map").groupBy("flag").count().orderBy("flag").collect()
        self.store("mapping", {"mapping": mapping.to_dict(), "fit": found, "flags": {str(r["flag"]): r["count"] for r in flags}})

    def verify(self) -> bool:
        result = checks.check_cuts(self.mapping(), self.frames(), self.onsets(self.labels[0]), self.onsets(self.labels[2]))
        self.store("verification", result)
        return result["pass"]

    def move_subtitles(self) -> None:
        for language, path in self.subtitles.items():
            rows = cues.retimed(subtitles.read_srt(self.spark, path), self.mapping())
            rows.write.mode("overwrite").parquet(f"{self.out}/cues/{language}")
            cues.as_text(rows.withColumn("order", F.col("start")), ["file"], "order").write.mode("overwrite").parquet(f"{self.out}/subtitles/{language}")

    def write_tracks(self) -> None:
        table = lambda name: recordings.canonical(self.spark, self.folder, name)
        all_ = [builders.annotation_track(table("annotations"))]
        all_ += [builders.cue_track(self.spark.read.parquet(f"{self.out}/cues/{language}"), language) for language in self.subtitles]
        if self.signal:
            all_.append(builders.alignment_track(self.spark.read.parquet(f"{self.out}/frame_map"), self.mapping()))
        if steps.exists(self.spark, f"{self.folder}/spikes"):
            track, binaries = builders.spike_track(table("units"), table("spikes"), table("watchlog"))
            binaries.write.mode("overwrite").parquet(f"{self.out}/spike_binaries")
            all_.append(track)
        for track in all_:
            tracks.write_tracks(track, f"{self.out}/tracks")

    def _signatures(self, *paths: str) -> dict:
        return {p: steps.file_signature(self.spark, p) for p in paths if steps.exists(self.spark, p)}

    def runner(self) -> steps.Runner:
        labels = f"{self.folder}/annotations"
        measured = [
            steps.Step("align", lambda: {"files": self._signatures(labels, self.signal)}, self.align, [f"{self.out}/mapping", f"{self.out}/frame_map"]),
            steps.Step("verify", lambda: {"files": self._signatures(labels, self.signal), "mapping": self.document("mapping")}, self.verify, [f"{self.out}/verification"], ["align"]),
        ]
        before = ["verify"] if self.signal else []
        rest = [
            steps.Step("subs", lambda: {"files": self._signatures(*self.subtitles.values()), "mapping": self.mapping().to_dict()}, self.move_subtitles, [f"{self.out}/subtitles/{x}" for x in self.subtitles], before),
            steps.Step("tracks", lambda: {"files": self._signatures(*(f"{self.folder}/{t}" for t in recordings.SCHEMAS))}, self.write_tracks, [f"{self.out}/tracks"], ["subs", *before]),
        ]
        return steps.Runner(self.spark, f"{self.out}/stamps", [*(measured if self.signal else []), *rest])


def registered(spark: SparkSession, registry: str, fingerprint: str, description: str, document: dict, verification: dict | None) -> DataFrame:
    """Puts a copy into the registry, a table (fingerprint, description, mapping, verification) of versions, in place of an older entry
    of the same fingerprint, and gives the new registry. Until that stands, the older one can be read."""
    schema = "fingerprint string, description string, mapping string, verification string"
    new = spark.createDataFrame([(fingerprint, description, json.dumps(document["mapping"]), json.dumps(verification))], schema)
    versions.write(steps.upserted(versions.read(spark, registry, schema), new, "fingerprint"), registry)
    return versions.read(spark, registry, schema)
