"""Tracks for viewers: four kinds of JSON document, a binary of spike times, and a manifest of what there is.

Each function takes a DataFrame and gives rows (id, header fields, body JSON); write_tracks() stores them. There a track is one
row, which is for tracks that a viewer loads whole. interval_parts(), text_parts(), series_parts() and spike_parts() give the same
bodies in ordered parts, for tracks of any length; write_document() stores those."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelark.operators import ordered

HEADER = ["id", "name", "type", "group", "description"]


def _head(df: DataFrame, kind: str, id: str, name: str, group: str, description: str) -> DataFrame:
    return df.select(F.lit(id).alias("id"), F.lit(name).alias("name"), F.lit(kind).alias("type"), F.lit(group).alias("group"), F.lit(description).alias("description"), "body")


def intervals(df: DataFrame, id: str, name: str, group: str = "", label_groups: dict[str, list[str]] | None = None, description: str = "") -> DataFrame:
    """From (label, order, a, b): labels with their intervals in the given order, rounded to milliseconds; and groups of labels,
    one with all labels if none are given."""
    # a label without intervals, as a row of nulls, keeps an empty list
    each = df.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("a").isNotNull(), F.struct("order", "a", "b")))), lambda s: F.array(F.round(s["a"], 3), F.round(s["b"], 3))).alias("spans"))
    all_ = each.groupBy().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "spans")))).alias("labels"))
    groups = F.create_map(F.lit(name), F.array_sort(F.map_keys("labels")))
    if label_groups:
        groups = F.create_map(*[x for k, v in label_groups.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return _head(all_.select(F.to_json(F.struct("labels", groups.alias("label_groups"))).alias("body")), "intervals", id, name, group, description)


def text(df: DataFrame, id: str, name: str, group: str = "", description: str = "") -> DataFrame:
    """From (a, b, text): segments rounded to milliseconds, then sorted."""
    rounded = df.select(F.struct(F.round("a", 3).alias("a"), F.round("b", 3).alias("b"), "text").alias("s"))
    body = rounded.groupBy().agg(F.array_sort(F.collect_list("s")).alias("segments"))
    return _head(body.select(F.to_json(F.struct("segments")).alias("body")), "text", id, name, group, description)


def series(df: DataFrame, id: str, name: str, t0: float, dt: float, group: str = "", unit: str = "", description: str = "") -> DataFrame:
    """From (i, v): values in single precision, rounded to five digits; those that aren't finite become null."""
    body = df.select(F.struct("i", finite(F.col("v")).alias("v")).alias("s")).groupBy().agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["v"]).alias("values"))
    return _head(body.select(F.to_json(F.struct(F.lit(t0).alias("t0"), F.lit(dt).alias("dt"), F.lit(unit).alias("unit"), "values"), {"ignoreNullFields": "false"}).alias("body")), "series", id, name, group, description)


def spike_offsets(spikes: DataFrame) -> DataFrame:
    """(patient, unit_id, offset, count): where each unit's times stand in its patient's binary, counted in numbers."""
    counts = spikes.groupBy("patient", "unit_id").agg(F.count("t").alias("count"))
    w = Window.partitionBy("patient").orderBy("unit_id").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("offset", F.sum("count").over(w) - F.col("count"))


def spike_parts(spikes: DataFrame, part: int = ordered.NUMBERS) -> DataFrame:
    """(patient, part, offset, data): each unit's times sorted, as little-endian single-precision numbers, units one after the
    other; parts joined in order are a patient's binary."""
    return ordered.numbers(spikes.select("patient", "unit_id", "t"), ["patient"], ["unit_id", "t"], "t", part)


def spike_binary(spikes: DataFrame) -> DataFrame:
    """(patient, data): spike_parts() joined, for binaries that fit into a row."""
    parts = spike_parts(spikes).groupBy("patient").agg(F.array_sort(F.collect_list(F.struct("part", F.hex("data").alias("x")))).alias("parts"))
    return parts.select("patient", F.unhex(F.array_join(F.transform("parts", lambda p: p["x"]), "")).alias("data"))


def finite(v: Column) -> Column:
    """In single precision, rounded to five digits; null if it isn't finite."""
    v = v.cast("float").cast("double")
    return F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")), F.round(v, 5))


def series_parts(df: DataFrame, t0: float, dt: float, unit: str = "", keys: list[str] = (), part: int = ordered.PART) -> DataFrame:
    """(keys, part, offset, text): the body that series() gives, of each key, from (keys, i, v)."""
    head = f'{{"t0":{json.dumps(t0)},"dt":{json.dumps(dt)},"unit":{json.dumps(unit)},"values":['
    text = F.coalesce(_json(finite(F.col("v"))), F.lit("null"))
    return ordered.document(df.select(*keys, "i", "v"), list(keys), "i", text, head, "]}", part=part)


def text_parts(df: DataFrame, keys: list[str] = (), part: int = ordered.PART) -> DataFrame:
    """(keys, part, offset, text): the body that text() gives, of each key, from (keys, a, b, text)."""
    rows = df.select(*keys, F.round("a", 3).alias("a"), F.round("b", 3).alias("b"), "text")
    return ordered.document(rows, list(keys), ["a", "b", "text"], F.to_json(F.struct("a", "b", "text")), '{"segments":[', "]}", part=part)


def interval_parts(df: DataFrame, part: int = ordered.PART) -> DataFrame:
    """(label, part, offset, text): of each label the array of its intervals, rounded to milliseconds, from (label, order, a, b);
    a row of nulls keeps a label without intervals."""
    pair = F.when(F.col("a").isNotNull(), F.to_json(F.array(F.round("a", 3), F.round("b", 3))))
    return ordered.document(df.select("label", "order", "a", "b"), ["label"], ["order", "a"], pair, part=part)


def _json(v: Column) -> Column:
    """A number as JSON; null stays null."""
    inside = F.to_json(F.array(v))
    return F.when(v.isNotNull(), inside.substr(F.lit(2), F.length(inside) - 2))


def spikes(units: DataFrame, times: DataFrame, id: str, name: str, group: str = "", description: str = "") -> DataFrame:
    """From units (patient, unit_id, region, hemisphere, single_unit, cell_type) and times (patient, unit_id, t)."""
    full = units.join(spike_offsets(times), ["patient", "unit_id"], "left").fillna(0, ["offset", "count"])
    unit = F.struct("unit_id", "region", "hemisphere", "single_unit", "cell_type", "offset", "count")
    each = full.groupBy("patient").agg(F.array_sort(F.collect_list(unit)).alias("units"))
    one = F.struct("patient", "units", F.concat(F.lit("spikes_"), F.col("patient").cast("string"), F.lit(".f32")).alias("bin"))
    body = each.groupBy().agg(F.array_sort(F.collect_list(one)).alias("patients"))
    return _head(body.select(F.to_json(F.struct("patients")).alias("body")), "spikes", id, name, group, description)


def group_of(labels: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """labels with the group each is in, null if in none; of several the first."""
    pairs = [(label, name) for name, own in reversed(groups.items()) for label in own]
    table = dict(pairs)
    if not table:
        return labels.withColumn("group", F.lit(None).cast("string"))
    return labels.withColumn("group", F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[F.col("label")])


def write_tracks(tracks: DataFrame, path: str) -> None:
    """JSON lines in a folder for each id: header and body as a string. A track that is there already is replaced, others stay."""
    tracks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("id").json(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The headers of all tracks under path, by id, and the file each is in. Only the header fields are parsed."""
    schema = ", ".join(f"`{c}` string" for c in HEADER)
    return spark.read.schema(schema).json(path).select(*HEADER, F.input_file_name().alias("url")).orderBy("id")
