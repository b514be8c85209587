"""Work files that driver and executors all see, and table access."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Only where the session names no folder and driver and executors are one process, as in tests.
LOCAL_FALLBACK = "/tmp/checkpoints"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """A fresh path under spark.checkpoint.dir, which every executor can reach."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = LOCAL_FALLBACK
    return f"{root.rstrip('/')}/work-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends
    there, and a lost executor costs only a read of replicated files."""
    spark = df.sparkSession
    path = work_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that staged() has written, once nothing reads it any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Delete what staged() and the archive writers of this application wrote."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(work_dir(spark)).getParent()
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
