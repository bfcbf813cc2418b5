"""Stream results that outlive the driver: one folder per batch, written again if a batch is repeated.

A batch that was interrupted runs again with the same number and the same files, and overwrites what it had
written, so every row is in the result once, whatever fails. Readers see all batches that have been written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators.sampling import in_bucket
from lumenfold.sources.checked import REASON, Checked, split

BATCH = "batch"
Part = Callable[[DataFrame], DataFrame]


def write_durably(stream: DataFrame, path: str, checkpoint: str, parts: dict[str, Part]) -> None:
    """Process all files that are there now, and write each of ``parts`` of every batch under ``path``.

    ``parts`` maps the name of an output to a function of the batch. Offsets lie in ``checkpoint``; given again, a
    later run goes on after the last complete batch. Both folders must be shared.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for name, part in parts.items():
                part(batch).write.mode("overwrite").parquet(f"{path}/{name}/{BATCH}={number}")
        finally:
            batch.unpersist()

    query = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_durable(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All batches of one output, with the number of the batch."""
    return spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}/{BATCH}=*")


def moments_of(amount: str) -> Part:
    """One row per batch: count, mean and sum of squared deviations of the amount."""
    value = F.col(amount).cast("double")
    return lambda batch: batch.agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("squares")
    )


def merged_moments(batches: DataFrame) -> DataFrame:
    """Count, mean and population standard deviation from the moments of all batches; null for no rows."""
    some = batches.where(F.col("n") > 0)
    n, mean = F.col("n"), F.col("mean")
    total = F.sum(n)
    overall = some.agg(F.try_divide(F.sum(n * mean), total)).scalar()
    return some.withColumn("overall", overall).agg(
        F.coalesce(total, F.lit(0)).alias("n"),
        F.max("overall").alias("mean"),
        F.sqrt(F.try_divide(F.sum(F.col("squares") + n * (mean - F.col("overall")) ** 2), total)).alias("std"),
    )


def durable_hash_sample(
    stream: DataFrame, key: str, amount: str, path: str, checkpoint: str, share: float = 0.01, bucket: int = 0
) -> DataFrame:
    """Count, mean and standard deviation over one hash bucket of the keys, from a result that stays in ``path``."""
    sampled = stream.where(in_bucket(key, share, bucket))
    write_durably(sampled, path, checkpoint, {"moments": moments_of(amount)})
    return merged_moments(read_durable(stream.sparkSession, path, "moments"))


def write_checked(parsed: DataFrame, names: Sequence[str], path: str, checkpoint: str) -> Checked:
    """Good rows and bad lines of a checked stream, as two durable outputs."""
    good = lambda batch: batch.where(F.col(REASON).isNull())
    bad = lambda batch: batch.where(F.col(REASON).isNotNull())
    write_durably(parsed, path, checkpoint, {"good": good, "bad": bad})
    spark = parsed.sparkSession
    return Checked(split(read_durable(spark, path, "good"), names).good, split(read_durable(spark, path, "bad"), names).bad)
