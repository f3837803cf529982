"""Labelled rows for training: which may be learned from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, learnable: Column, limit: int) -> DataFrame:
    """(doc_id, y, text) of at most limit labelled documents, those with the smallest hashes of their ids; one row for each id.

    learnable is a condition on doc_id. Labels other than 0 and 1, and nulls, are left out; of several labels of one id
    the largest counts, of several documents the smallest text. The sample of labels has limit rows at most, so it is
    broadcast to the documents; documents that share an id meet in their tasks before they are shuffled."""
    clean = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = clean.filter(learnable).groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.min("text").alias("text"))
