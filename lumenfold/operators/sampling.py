"""Samples by key: an exact share of the distinct keys, and a hash bucket."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.functions.text import key_bucket, key_digest
from lumenfold.plans.stage import stage

# Hexadecimal digits of a digest, digits per step of the selection, and keys that one task sorts.
DIGEST_DIGITS = 32
RADIX = 4
SORTED_KEYS = 100_000


def distinct_keys(rows: DataFrame, key: str) -> DataFrame:
    """The distinct non-null keys."""
    return rows.select(key).where(F.col(key).isNotNull()).distinct()


def key_cutoff(keys: DataFrame, key: str, share: float, salt: str = "") -> str | None:
    """The largest digest among the first floor(n * share) of distinct keys; None if there is none.

    Radix selection: a histogram over the next ``RADIX`` hexadecimal digits of the digests (at most 65,536
    rows) shows in which bucket the cutoff falls, and only that bucket is looked at next, until
    it is short enough to be sorted by one task. So an exact share of any number of keys is found
    without a global sort or a collected list. ``keys`` should be staged; each step reads it.
    """
    digests = keys.select(key_digest(F.col(key), salt).alias("digest"))
    wanted = math.floor(digests.count() * float(share))
    prefix = ""
    while wanted > 0 and len(prefix) < DIGEST_DIGITS:
        inside = digests.where(F.col("digest").startswith(prefix))
        sizes = inside.groupBy(F.substring("digest", len(prefix) + 1, RADIX).alias("head")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("head").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        edge = sizes.withColumn("reached", upto).where(F.col("reached") >= wanted).orderBy("head").first()
        prefix += edge["head"]
        wanted -= edge["reached"] - edge["n"]
        if edge["n"] <= SORTED_KEYS:
            bucket = digests.where(F.col("digest").startswith(prefix))
            place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("digest"))
            return bucket.withColumn("place", place).where(F.col("place") == wanted).first()["digest"]
    return prefix or None


def staged_keys(rows: DataFrame, key: str) -> DataFrame:
    """The distinct keys, shuffled and written once."""
    return stage(distinct_keys(rows, key), "distinct-keys")


def in_sample(key: str, cutoff: str | None, salt: str = "") -> Column:
    """Condition: the key belongs to the sampled share of the keys.

    Membership is one comparison with the cutoff, so no key list is joined and a hot
    key costs nothing.
    """
    return F.lit(False) if cutoff is None else key_digest(F.col(key), salt) <= cutoff


def sampled_keys(rows: DataFrame, key: str, share: float, salt: str = "") -> DataFrame:
    """A repeatable random subset of floor(n * share) of the distinct keys."""
    keys = staged_keys(rows, key)
    return keys.where(in_sample(key, key_cutoff(keys, key, share, salt), salt))


def in_key_sample(rows: DataFrame, key: str, share: float, salt: str = "") -> Column:
    """Condition on ``rows``: the key belongs to the sampled share of the keys."""
    return in_sample(key, key_cutoff(staged_keys(rows, key), key, share, salt), salt)


def sampled_rows(rows: DataFrame, key: str, share: float, salt: str = "") -> DataFrame:
    """All rows whose key is in :func:`sampled_keys`."""
    return rows.where(in_key_sample(rows, key, share, salt))


def keep_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a given key table (left semi join; a hot key is split by AQE)."""
    return rows.join(keys.select(key), key, "left_semi")


def amount_moments(rows: DataFrame, amount: str) -> DataFrame:
    """Count, mean and population standard deviation of the amount; null for no rows."""
    value = F.col(amount).cast("double")
    return rows.agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")
    )


def two_pass_sample(rows: DataFrame, key: str, amount: str, share: float = 0.01, salt: str = "") -> DataFrame:
    """Moments of the amount over a share of the keys: one pass for keys, one for rows."""
    return amount_moments(sampled_rows(rows, key, share, salt), amount)


def buckets_for(share: float) -> int:
    """Number of hash buckets of which one holds about ``share`` of the keys."""
    return max(1, round(1 / share))


def choose_bucket(share: float, seed: int) -> int:
    """A bucket chosen once per run, repeatable by seed."""
    return random.Random(seed).randrange(buckets_for(share))


def in_bucket(key: str, share: float, bucket: int) -> Column:
    """Condition: the key hashes into the bucket. Works on batch and streaming rows."""
    return key_bucket(F.col(key), buckets_for(share)) == F.lit(bucket)


def hash_sample(rows: DataFrame, key: str, amount: str, share: float = 0.01, bucket: int = 0) -> DataFrame:
    """Moments of the amount over one hash bucket of the keys, in a single pass."""
    return amount_moments(rows.where(in_bucket(key, share, bucket)), amount)
