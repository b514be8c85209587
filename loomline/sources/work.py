"""Where work is done: lineage cut at the checkpoint folder, rows of few files spread over all cores."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which driver and executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (folder or "/tmp/checkpoints").rstrip("/")


def fresh_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the checkpoint folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """df, dealt over all cores where it is read in fewer splits than there are cores; otherwise, and after any shuffle, as it is.

    For work that costs much more than a shuffle of its rows: one large row group is one task."""
    if df.isStreaming:
        return df
    plan = df._jdf.queryExecution()
    if "Exchange" in plan.executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if plan.toRdd().getNumPartitions() < cores else df


def footers(spark: SparkSession, *paths: str) -> DataFrame:
    """One row, the number of rows of Parquet files: the count is pushed down to their footers, no column is read."""
    session = spark.newSession()  # these settings are its own
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(*paths).agg(F.count(F.lit(1)).alias("row_count"))


def footer_count(spark: SparkSession, *paths: str) -> int:
    return (footers(spark, *paths).first().row_count or 0) if paths else 0  # null for files without row groups
