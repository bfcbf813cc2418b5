"""Staging of intermediate tables in a folder that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this cluster, as named by ``spark.checkpoint.dir``.

    A session without the setting is an error: executors do not share local disks, so
    the library never picks a folder by itself.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/lumenfold/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Later uses scan parquet instead of repeating the work, a lost executor costs
    no recomputation, and the optimizer sees the real size of the result.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_stage(spark: SparkSession) -> None:
    """Delete what this application has staged. Frames built on it cannot be used afterwards."""
    folder = f"{shared_dir(spark)}/lumenfold/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
