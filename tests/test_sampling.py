import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.operators import sampling
from lumenfold.streaming import run_to_end, stream_hash_sample

KEYS = [f"u{k}" for k in range(237)]


@pytest.fixture(scope="module")
def rows(spark):
    # The first user holds a third of the rows.
    data = [(KEYS[0] if n % 3 == 0 else KEYS[(n * 7) % 237], float(n % 100)) for n in range(3000)]
    return spark.createDataFrame(data, "user string, amount double")


@pytest.mark.parametrize("share", [0.0, 0.004, 0.02, 0.5, 1.0])
def test_exact_share_of_the_keys(rows, share):
    keys = {r[0] for r in rows.select("user").distinct().collect()}
    ordered = sorted(keys, key=lambda k: hashlib.md5(("x" + k).encode()).hexdigest())
    want = set(ordered[: int(len(keys) * share)])
    got = [r[0] for r in sampling.sampled_keys(rows, "user", share, "x").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    kept = sampling.sampled_rows(rows, "user", share, "x")
    joined = sampling.keep_keys(rows, sampling.sampled_keys(rows, "user", share, "x"), "user")
    assert sorted(kept.collect()) == sorted(joined.collect())


def test_two_pass_moments(rows):
    kept = [r["amount"] for r in sampling.sampled_rows(rows, "user", 0.1).collect()]
    got = sampling.two_pass_sample(rows, "user", "amount", 0.1).first()
    assert got["n"] == len(kept)
    assert got["mean"] == pytest.approx(np.mean(kept)) and got["std"] == pytest.approx(np.std(kept))


def test_empty_sample_is_null(rows):
    got = sampling.two_pass_sample(rows, "user", "amount", 0.0).first()
    assert tuple(got) == (0, None, None)
    assert tuple(sampling.hash_sample(rows.limit(0), "user", "amount", 0.5).first()) == (0, None, None)


def test_buckets_partition_the_rows(rows):
    parts = [sampling.hash_sample(rows, "user", "amount", 0.25, b).first()["n"] for b in range(4)]
    assert sum(parts) == rows.count() and sampling.buckets_for(0.3) == 3
    assert 0 <= sampling.choose_bucket(0.02, 5) == sampling.choose_bucket(0.02, 5) < 50


def test_stream_equals_batch(spark, rows, tmp_path):
    rows.repartition(3).write.csv(str(tmp_path / "txn"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).csv(str(tmp_path / "txn"))
    got = run_to_end(stream_hash_sample(stream, "user", "amount", 0.2, 1)).first()
    want = sampling.hash_sample(rows, "user", "amount", 0.2, 1).first()
    assert got["n"] == want["n"] and math.isclose(got["mean"], want["mean"]) and math.isclose(got["std"], want["std"])


def test_stream_goes_on_from_its_checkpoint(spark, rows, tmp_path):
    folder, checkpoint = str(tmp_path / "txn"), str(tmp_path / "state")
    stream = lambda: stream_hash_sample(spark.readStream.schema(rows.schema).csv(folder), "user", "amount", 0.5, 0)
    half = rows.withColumn("n", F.monotonically_increasing_id() % 2).cache()
    half.where("n = 0").drop("n").write.csv(folder)
    first = run_to_end(stream(), checkpoint).first()["n"]
    half.where("n = 1").drop("n").write.mode("append").csv(folder)
    second = run_to_end(stream(), checkpoint).first()
    want = sampling.hash_sample(rows, "user", "amount", 0.5, 0).first()
    assert 0 < first < second["n"] == want["n"] and math.isclose(second["mean"], want["mean"])


def test_digest_is_md5(spark):
    from lumenfold.functions.text import key_bucket, key_digest

    row = spark.range(1).select(key_digest(F.lit(42)), key_bucket(F.lit(42), 50)).first()
    digest = hashlib.md5(b"42").hexdigest()
    assert tuple(row) == (digest, int(digest[:8], 16) % 50)


@pytest.mark.parametrize("sorted_keys", [1, 3, 50])
def test_radix_steps_find_the_same_cutoff(spark, rows, monkeypatch, sorted_keys):
    monkeypatch.setattr(sampling, "SORTED_KEYS", sorted_keys)
    monkeypatch.setattr(sampling, "RADIX", 1)
    ordered = sorted({r[0] for r in rows.select("user").distinct().collect()}, key=lambda k: hashlib.md5(k.encode()).hexdigest())
    for share in (0.01, 0.3, 1.0):
        got = {r[0] for r in sampling.sampled_keys(rows, "user", share).collect()}
        assert got == set(ordered[: math.floor(len(ordered) * share)])


def test_the_keys_are_shuffled_once(spark, tmp_path, monkeypatch):
    """Counting, both levels of the selection and the result read the written keys, not the rows."""
    rows = spark.range(500).select((F.col("id") % 50).cast("string").alias("user"))
    staged = []
    real = sampling.stage
    monkeypatch.setattr(sampling, "stage", lambda df, name: staged.append(name) or real(df, name))
    keys = sampling.sampled_keys(rows, "user", 0.2)
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert staged == ["distinct-keys"] and "Exchange" not in plan and "Range" not in plan and keys.count() == 10
