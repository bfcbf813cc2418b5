"""Panels laid out on disk for the joins and years they are read by.

A laid-out panel is a table that is partitioned by year and bucketed and sorted by entity. A range of
years reads only its folders, and panels with the same number of buckets join, and aggregate by entity, without an
exchange: each task reads the same bucket of both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.plans.stage import scratch_path

BUCKETS = 64


def write_panel(
    panel: DataFrame, name: str, path: str | None = None, entity: str = "entity", year: str = "year", buckets: int = BUCKETS, mode: str = "error"
) -> DataFrame:
    """Write ``panel`` as table ``name``, in files under ``path`` (by default a fresh shared folder), and read it.

    Rows are first dealt by entity, so that each bucket of a year is one file. Panels that are to be joined need the same
    number of buckets: about as many as the largest of them has hundred megabytes a year.
    """
    spark = panel.sparkSession
    dealt = panel.repartition(buckets, F.col(entity))
    writer = dealt.write.mode(mode).format("parquet").partitionBy(year).bucketBy(buckets, entity).sortBy(entity)
    writer.option("path", path or scratch_path(spark, name)).saveAsTable(name)
    return read_panel(spark, name)


def read_panel(spark: SparkSession, name: str, years: tuple[int, int] | None = None, year: str = "year") -> DataFrame:
    """A laid-out panel, or its years from the first to the last given; other years are not read."""
    panel = spark.table(name)
    return panel if years is None else panel.where(F.col(year).between(*years))


def drop_panel(spark: SparkSession, name: str) -> None:
    """Forget the table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def join_laid_out(a: DataFrame, b: DataFrame, entity: str = "entity", year: str = "year") -> DataFrame:
    """Inner join of two laid-out panels on entity and year, bucket by bucket.

    Buckets are by entity alone, so the entity alone is the key of the join; equal years are a condition on
    the pairs, written as a difference because an equality would become a second key and ask for an exchange.
    An entity has a row per year, so its pairs are few.
    """
    other = b.withColumnRenamed(entity, "_entity").withColumnRenamed(year, "_year")
    same = (F.col(entity) == F.col("_entity")) & (F.col(year) - F.col("_year") == 0)
    return a.join(other.hint("merge"), same).drop("_entity", "_year")


def mean_laid_out(panel: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("entity", "year")) -> DataFrame:
    """Mean of each column per key, the entity among the keys: the buckets already hold whole groups."""
    return panel.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])
