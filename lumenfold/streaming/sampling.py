"""One-pass sample of a file stream with running moments."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from lumenfold.operators.sampling import amount_moments, in_bucket
from lumenfold.plans.stage import scratch_path


def stream_hash_sample(stream: DataFrame, key: str, amount: str, share: float = 0.01, bucket: int = 0) -> DataFrame:
    """Running count, mean and standard deviation over one hash bucket of the keys.

    The state is one row of mergeable moments; no sampled row or key is kept.
    """
    return amount_moments(stream.where(in_bucket(key, share, bucket)), amount)


def run_to_end(result: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """Process all files that are there now and return the final one-row result.

    State and offsets lie in ``checkpoint``; given again, a later run reads only the new
    files and goes on from the old moments. By default it is a fresh shared folder.
    """
    spark = result.sparkSession
    name = f"running_{uuid.uuid4().hex}"
    query = (
        result.writeStream.outputMode("complete")
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.table(name)
