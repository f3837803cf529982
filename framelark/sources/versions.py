"""Small tables that are replaced whole, so that a reader always finds one whole version: registries, documents, stamps.

A version is written to a folder of its own; then one row that names it is appended to the table of pointers, in one file,
which Spark's committer puts in place by a rename. Until that the version before counts, whatever happens to the writer."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_POINTER = "number long, version string"


def _pointers(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_POINTER).json(f"{path}/pointers")
    except AnalysisException:  # there is none yet
        return None


def current(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """Number and name of the version that counts: the highest number; of writers that took the same number the greater name."""
    pointers = _pointers(spark, path)
    row = None if pointers is None else pointers.agg(F.max(F.struct("number", "version")).alias("m")).first()["m"]
    return None if row is None else (row["number"], row["version"])


def write(df: DataFrame, path: str) -> None:
    """Makes df the table at path. df may be read from it: the version it reads stays until pruned()."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{path}/versions/{name}")
    before = current(spark, path)
    row = spark.createDataFrame([(before[0] + 1 if before else 0, name)], _POINTER).coalesce(1)
    row.write.mode("append").json(f"{path}/pointers")


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at path; no rows if there is none."""
    found = current(spark, path)
    return spark.createDataFrame([], schema) if found is None else spark.read.schema(schema).parquet(f"{path}/versions/{found[1]}")


def pruned(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Frees all versions but the last `keep`, and gives how many: nothing is written over them. Readers that still read an
    older one than those are cut off, so keep covers how long a reader takes."""
    pointers = _pointers(spark, path)
    rows = [] if pointers is None else pointers.orderBy(F.desc("number"), F.desc("version")).collect()  # a row for each write
    for r in rows[keep:]:
        old = spark.read.parquet(f"{path}/versions/{r['version']}")
        old.limit(0).write.mode("overwrite").parquet(f"{path}/versions/{r['version']}")
    return len(rows[keep:])
