"""Timed text: SubRip files and JSON cues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark.functions.text import stripped, without_mark, without_tags

CUE = "array<struct<start:double,end:double,text:string>>"
ARROW = "-->"


def _seconds(stamp: Column) -> Column:
    """Hours, minutes, seconds and milliseconds, cut at colons and the decimal mark; null if stamp holds no such time."""
    found = F.split(F.regexp_extract(stamp, r"\d+(:\d+){2}[.,]\d+", 0), "[:.,]")
    number = lambda i: F.try_element_at(found, F.lit(i)).try_cast("double")
    return number(1) * 3600 + number(2) * 60 + number(3) + number(4) / 1000


def parsed(text: Column) -> Column:
    """Array of (start, end, text) of a SubRip text: blocks between blank lines; in each, the times stand around the arrow and the
    text on the lines below. Tags go, and so do blocks without times or text."""

    def cue(lines: Column) -> Column:
        at = F.array_position(F.transform(lines, lambda line: F.instr(line, ARROW) > 0), True)
        times = F.split(F.get(lines, at.cast("int") - 1), ARROW)
        said = F.array_join(F.slice(lines, at.cast("int") + 1, F.size(lines)), "\n")
        return F.struct(_seconds(F.get(times, F.lit(0))).alias("start"), _seconds(F.get(times, F.lit(1))).alias("end"), stripped(without_tags(said)).alias("text"))

    blocks = F.transform(F.split(without_mark(text), r"\n\n+"), lambda b: F.split(b, "\n"))
    cues = F.transform(F.filter(blocks, lambda lines: F.exists(lines, lambda line: F.instr(line, ARROW) > 0)), cue)
    return F.filter(cues, lambda c: (F.length(c["text"]) > 0) & c["start"].isNotNull() & c["end"].isNotNull())


def read_srt(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, end, text) of all SubRip files that path names; a file is one row, as a cue can cross any split."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value"))
    return files.select("file", F.inline(parsed(F.col("value"))))


def read_cues(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value"))
    return files.select("file", F.inline(F.from_json("value", CUE)))
