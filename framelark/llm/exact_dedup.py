"""Exact deduplication: group by a 128-bit content hash, compare bytes inside each group, keep the smallest id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelark.llm.common import checkpointed, left_join_by_key

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row for each row of docs: id, keep_id, group_size, kept, text_sha256.

    Rows are equal when their normalised texts have the same bytes; the smallest id of a group is kept. digest only
    groups them: the grouping key holds the text itself beside its hash, so texts whose hashes collide stay apart.

    Null text counts as empty, so null and empty texts form one group. Null ids: ignored for keep_id; in a group of null
    ids only, keep_id is null and the rows are kept. Rows that repeat an id count each in group_size and share kept.
    No rows give no rows. Other columns are ignored."""
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    rows = rows.withColumn("h", digest(F.col("norm")))
    # Copies within a task meet before the shuffle; after it, one row for each text is left.
    texts = rows.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    hashes = checkpointed(
        texts.groupBy("h").agg(
            F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("n_texts")
        )
    )
    narrow = rows.select("doc_id", "h", F.sha2("norm", 256).alias("text_sha256"))
    out = left_join_by_key(narrow, hashes, "h", "group_size")
    collided = hashes.filter("n_texts > 1").select("h")
    if not collided.isEmpty():  # different texts behind one hash: join those on the text as well
        again = rows.join(collided, "h", "left_semi").join(texts, ["h", "norm"])
        again = again.select("doc_id", "h", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size", F.lit(1).alias("n_texts"))
        out = out.filter("n_texts = 1").unionByName(again)
    return out.select(
        F.col("doc_id").alias(id_col), "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
     g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
