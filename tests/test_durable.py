import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.operators import sampling
from lumenfold.streaming import durable

SCHEMA = "user string, amount double"


@pytest.fixture
def files(spark, tmp_path):
    """Four files, so four batches of one file each."""
    for part in range(4):
        rows = [(f"u{(n * 7 + part) % 40}", float(n * part % 83)) for n in range(120)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def stream(spark, files):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(files)


def same(got, want):
    assert got["n"] == want["n"] and got["mean"] == pytest.approx(want["mean"]) and got["std"] == pytest.approx(want["std"])


def test_equals_the_batch_and_outlives_the_query(spark, files, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    want = sampling.hash_sample(spark.read.parquet(files), "user", "amount", 0.25, 1).first()
    same(durable.durable_hash_sample(stream(spark, files), "user", "amount", out, state, 0.25, 1).first(), want)
    batches = durable.read_durable(spark, out, "moments")
    assert batches.count() == 4
    same(durable.merged_moments(batches).first(), want)


def test_an_interrupted_batch_is_not_counted_twice(spark, files, tmp_path):
    """The third batch writes its rows and then fails; the next run repeats it."""
    out, state, left = str(tmp_path / "out"), str(tmp_path / "state"), [1]

    def fails_once(batch):
        rows = batch.select("user", "amount")
        if durable_batches() == 2 and left:
            left.pop()
            rows.write.mode("overwrite").parquet(f"{out}/rows/batch=2")
            raise RuntimeError("lost in the middle")
        return rows

    def durable_batches():
        try:
            return durable.read_durable(spark, out, "rows").select("batch").distinct().count()
        except Exception:  # noqa: BLE001
            return 0

    with pytest.raises(Exception, match="lost in the middle"):
        durable.write_durably(stream(spark, files), out, state, {"rows": fails_once})
    assert durable.read_durable(spark, out, "rows").count() == 360
    durable.write_durably(stream(spark, files), out, state, {"rows": fails_once})
    got = durable.read_durable(spark, out, "rows")
    assert got.count() == 480
    assert sorted(got.select("user", "amount").collect()) == sorted(spark.read.parquet(files).collect())


def test_a_repeated_run_adds_nothing(spark, files, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        got = durable.durable_hash_sample(stream(spark, files), "user", "amount", out, state, 1.0, 0).first()
    assert got["n"] == 480


def test_moments_merge_as_one_sample(spark):
    rng = np.random.default_rng(1)
    parts = [rng.normal(1e6, 1, n) for n in (5, 1, 300)] + [np.array([])]
    rows = [(len(p), float(p.mean()) if len(p) else None, float(((p - p.mean()) ** 2).sum()) if len(p) else None) for p in parts]
    got = durable.merged_moments(spark.createDataFrame(rows, "n long, mean double, squares double")).first()
    whole = np.concatenate(parts)
    assert got["n"] == 306 and got["mean"] == pytest.approx(whole.mean()) and got["std"] == pytest.approx(whole.std(), rel=1e-6)
    none = durable.merged_moments(spark.createDataFrame(rows[3:], "n long, mean double, squares double")).first()
    assert tuple(none) == (0, None, None)
    assert F is not None
