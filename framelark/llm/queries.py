"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from framelark.llm import alignment, chat, decontaminate, exact_dedup, fingerprint, html_crf, line_dedup, packing, quality, sentencepiece_dropout, simhash, toxicity, vector_codes
from framelark.llm.common import documents


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, folder))


def op2_sentencepiece_dropout(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_dropout.encoded_and_checked(documents(spark, folder))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_crf.extract(spark.read.parquet(f"{folder}/pages.parquet"))


def op4_pack_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_tokens(documents(spark, folder))


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    return chat.digests(chat.format_chat(chat.with_planted(spark, turns)))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, folder))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontaminate(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op11_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(documents(spark, folder))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment(documents(spark, folder))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.vector_codes(spark.read.parquet(f"{folder}/embeddings.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_exact_dedup, op2_sentencepiece_dropout, op3_html_extraction, op4_pack_tokens, op5_chat_format, op6_line_dedup, op7_toxicity, op8_simhash, op9_quality, op10_decontaminate, op11_fingerprint, op12_alignment, op13_vector_codes)} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": exact_dedup.SQL, "op5_chat_format": chat.SQL, "op6_line_dedup": line_dedup.SQL, "op10_decontaminate": decontaminate.SQL, "op11_fingerprint": fingerprint.SQL, "op13_vector_codes": vector_codes.SQL}
