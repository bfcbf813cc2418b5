"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, partitions: int | None = None) -> DataFrame:
    """One parquet table of ``folder``; ``partitions`` deals its rows out, for CPU-heavy work on one split."""
    scan = spark.read.parquet(f"{folder}/{name}.parquet")
    return scan.repartition(partitions) if partitions else scan


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a file stream, whether it is stored as a file or as a folder of files."""
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parquet*")
