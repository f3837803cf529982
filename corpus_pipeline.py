"""From raw documents to token ids: quality, exact copies, near copies, benchmark passages, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. It decides for each row by its own text,
whether ids are null or repeated: of equal or linked rows one stays, that with the smallest id, rows without an id last. No
stage shuffles whole rows to bring decisions back to them: what goes is a small table of row numbers, which Spark broadcasts
while it is small, and rows that the benchmark can't hit pass by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelark.llm import decontaminate, exact_dedup, quality, sentencepiece_dropout, simhash
from framelark.llm.common import documents, emptied, own_tables, written


def _columns_of(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


#: The row's number within a stage, and its place among rows: by id, rows without one last, then by number. Places are unique.
ROW, PLACE = "_framelark_row", "_framelark_place"


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """docs, written with a number for each row, so that all that reads it sees the same numbers."""
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), f"{name}-rows")


def _placed(docs: DataFrame) -> DataFrame:
    return docs.select("text", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col(ROW)).alias(PLACE))


def _without(docs: DataFrame, dropped: DataFrame, name: str) -> DataFrame:
    """docs without the places in dropped. That table's size is known once it is written, so Spark can choose the join by it."""
    gone = written(dropped.select(F.col(f"{PLACE}.{ROW}").alias(ROW)), f"{name}-dropped")
    return docs.join(gone, ROW, "left_anti")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It is trained on those labelled documents that are in docs."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.with_score(docs, labels, "_framelark_score")
    return scored.filter(F.col("_framelark_score") >= quality.THRESHOLD).select(*_columns_of(docs))


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, one with the smallest id."""
    rows = _numbered(docs, "exact_dedup")
    own = exact_dedup.exact_dedup(_placed(rows), PLACE)
    return _without(rows, own.filter("NOT kept"), "exact_dedup").select(*_columns_of(docs))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that SimHash links, directly or by others, one with the smallest id."""
    rows = _numbered(docs, "simhash")
    own = simhash.near_duplicates(_placed(rows), PLACE)
    return _without(rows, own.filter(F.col(PLACE) != F.col("component_id")), "simhash").select(*_columns_of(docs))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages don't contaminate."""
    benchmark = decontaminate.Benchmark(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    rows = written(benchmark.with_candidates(docs, "text"), "decontaminate-rows")
    some = F.size(decontaminate.RUNS) > 0
    suspect = rows.filter(some).join(benchmark.hits(rows).select(decontaminate.ROW, "n_hit"), decontaminate.ROW, "left")
    cleared = suspect.filter(~decontaminate.contaminated(F.coalesce("n_hit", F.lit(0)), F.col(decontaminate.N_WORDS)))
    return rows.filter(~some).select(*_columns_of(docs)).unionByName(cleared.select(*_columns_of(docs)))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their SentencePiece ids under merge-dropout."""
    return sentencepiece_dropout.encode(docs)


STAGES = [("quality", good_quality), ("exact_dedup", first_copies), ("simhash", one_of_near_copies), ("decontaminate", without_benchmark), ("sentencepiece", encoded)]

#: Trees, keyed hashes and the search for linked fingerprints have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded documents that all stages keep. Each run frees the tables of its own stages and of no other run."""
    docs = documents(spark, sf_dir)
    with own_tables() as own:
        for name, stage in STAGES[:-1]:
            docs = written(stage(spark, docs, sf_dir), name)
            emptied(spark, own, docs)  # what this stage was made from
    return STAGES[-1][1](spark, docs, sf_dir)
