"""CSV and JSON-lines scans with explicit schemas, file streams and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Headerless transactions: two leading columns nobody reads, then user and amount.
TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("moment", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
    ]
)

# Review fields, as they stand in the JSON lines.
REVIEWS = T.StructType(
    [
        T.StructField("reviewerID", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("reviewText", T.StringType()),
        T.StructField("overall", T.DoubleType()),
        T.StructField("verified", T.BooleanType()),
    ]
)


def read_transactions(spark: SparkSession, path: str, schema: T.StructType = TRANSACTIONS) -> DataFrame:
    """Headerless transaction CSV."""
    return spark.read.schema(schema).csv(path)


def stream_transactions(spark: SparkSession, path: str, schema: T.StructType = TRANSACTIONS) -> DataFrame:
    """Headerless transaction CSV files of a folder, each read once as they arrive."""
    return spark.readStream.schema(schema).csv(path)


def read_reviews(
    spark: SparkSession, path: str, schema: T.StructType = REVIEWS, partitions: int | None = None
) -> DataFrame:
    """JSON-lines reviews, plain or gzip. ``partitions`` deals out the rows of a file that cannot be split."""
    rows = spark.read.schema(schema).json(path)
    return rows.repartition(partitions) if partitions else rows


def read_header_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with a header, every column as text; the header is checked against the names."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return _checked(spark, path, schema)


def read_numeric_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with a header and only numbers, such as a prepared panel."""
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in columns])
    return _checked(spark, path, schema)


def _checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV with a header."""
    df.write.mode(mode).option("header", True).csv(path)


def write_tuples(df: DataFrame, path: str, mode: str = "error") -> None:
    """One line of comma-separated values per row, no header."""
    df.write.mode(mode).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    """Parquet, the default between jobs."""
    df.write.mode(mode).parquet(path)
