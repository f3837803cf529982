"""Tables kept on the way, in the folder that a cluster's driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the checkpoint folder that was set for the session.

    Where neither is set a temporary folder takes its place, on one machine only: on a cluster no other could read it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="framelark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder. Spark deletes it where it is told to, by
    spark.cleaner.referenceTracking.cleanCheckpoints."""
    folder = shared_folder(df.sparkSession)
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
