"""Line deduplication by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.llm.common import checkpointed, left_join_by_key, let

WINDOW = 3


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def window_hashes(text: Column, window: int) -> Column:
    """A 128-bit hash for each run of window consecutive lines; element i starts at line i."""

    def hashed(lines: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(lines) - F.lit(window - 1))
        each = F.transform(starts, lambda i: F.unhex(F.md5(F.array_join(F.slice(lines, i, F.lit(window)), "\n"))))
        return F.when(F.size(lines) >= window, each).otherwise(F.array().cast("array<binary>"))

    return let(lines_of(text), hashed)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each row of docs: id, text without repeated lines, n_lines, n_removed.

    A window is `window` consecutive lines. Its first occurrence is the one with the smallest (id, line); all lines that
    any later occurrence covers go, also where occurrences overlap, within a document too. The first keeps its lines
    unless another repeated window covers them.

    Null text counts as empty (one empty line). Texts of fewer lines than a window stay as they are, empty and white
    lines are lines like others. Null ids come after all others. Rows that share an id, or have none, are documents of
    their own where their texts differ, in the order of a hash of them; where id and text are equal, all such rows count
    as one document and keep what it keeps. No rows give no rows. Other columns are ignored."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("own"))
    windows = rows.select("doc_id", "own", F.posexplode(window_hashes(F.col("text"), window)).alias("line", "h"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "own", "line")
    repeated = checkpointed(
        windows.groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    later = left_join_by_key(windows, repeated, "h", "n").filter(F.col("first").isNotNull() & (place > F.col("first")))
    # one row for each document: its windows are as many as its lines at most
    covered = later.groupBy("doc_id", "own").agg(F.collect_set("line").alias("starts"))
    covered = covered.select(F.col("doc_id").alias("of"), F.col("own").alias("of_own"), "starts")
    joined = rows.join(covered, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("own") == F.col("of_own")), "left")
    joined = joined.withColumn("starts", F.coalesce("starts", F.array().cast("array<int>")))
    removed = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.lit(window - 1)))))

    def rest(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed"))
        text = F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + 1)), "\n")
        return F.struct(text.alias("text"), F.size(lines).cast("long").alias("n_lines"))

    joined = joined.withColumn("removed", removed)
    out = joined.select("doc_id", let(lines_of(F.col("text")), rest).alias("rest"), F.size("removed").cast("long").alias("n_removed"))
    return out.select(F.col("doc_id").alias(id_col), F.col("rest.text").alias("text"), F.col("rest.n_lines").alias("n_lines"), "n_removed")


SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
     w AS (SELECT a.doc_id, a.i, a.line || chr(10) || b.line || chr(10) || c.line AS win
           FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.i = a.i + 1 JOIN l c ON a.doc_id = c.doc_id AND c.i = a.i + 2),
     k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS rn FROM w),
     cut AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM k WHERE rn > 1)
SELECT l.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE cut.i IS NULL), '') AS text,
       count(*) AS n_lines, count(cut.i) AS n_removed
FROM l LEFT JOIN cut ON cut.doc_id = l.doc_id AND cut.i = l.i GROUP BY l.doc_id
"""
