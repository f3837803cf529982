"""Names of the queries, what runs them and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framelark.plans import event_queries, plan_queries  # noqa: F401  (registers its queries)
from framelark.plans.event_queries import Query


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return event_queries.q_clicks_by_bin(spark, folder)


def queries() -> dict[str, Query]:
    return dict(event_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(event_queries.SQL)
