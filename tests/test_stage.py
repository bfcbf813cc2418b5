import os

import pytest
from pyspark.sql import functions as F

from lumenfold import sources
from lumenfold.plans import clear_stage, shared_dir, stage


def test_staged_table_is_the_same_and_lies_in_the_shared_folder(spark):
    df = spark.range(10).select("id", F.array(F.col("id") * 1.5).alias("v"))
    staged = stage(df, "t")
    assert staged.schema.simpleString() == df.schema.simpleString()
    assert sorted(staged.collect()) == sorted(df.collect())
    assert shared_dir(spark).removeprefix("file:") in staged.inputFiles()[0]


def test_shared_folder_follows_the_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")


def test_clear_stage_deletes_what_the_application_staged(spark):
    file = stage(spark.range(3), "t").inputFiles()[0].removeprefix("file://")
    assert os.path.exists(file)
    clear_stage(spark)
    assert not os.path.exists(file)


def test_a_session_without_a_shared_folder_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    with pytest.raises(ValueError):
        shared_dir(spark)


def test_rows_are_dealt_out_only_on_request(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    assert sources.table(spark, str(tmp_path), "t").rdd.getNumPartitions() == 1
    assert sources.table(spark, str(tmp_path), "t", 5).rdd.getNumPartitions() == 5


def test_stream_of_a_folder_table_equals_batch(spark, tmp_path):
    from lumenfold.operators.sampling import hash_sample
    from lumenfold.sources.tables import stream_table
    from lumenfold.streaming import run_to_end, stream_hash_sample

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    streamed = run_to_end(stream_hash_sample(stream_table(spark, str(tmp_path), "events"), "user_id", "value", 0.5))
    batch = hash_sample(events, "user_id", "value", 0.5)
    assert streamed.first()["n"] == batch.first()["n"] > 0


def test_files_round_trip(spark, tmp_path):
    panel = spark.createDataFrame([(1.0, 2.5), (2.0, None)], "entity double, x double")
    sources.write_csv(panel, str(tmp_path / "csv"))
    assert sorted(sources.read_numeric_csv(spark, str(tmp_path / "csv"), ["entity", "x"]).collect()) == sorted(panel.collect())
    texts = sources.read_header_csv(spark, str(tmp_path / "csv"), ["entity", "x"])
    assert sorted((r["entity"], r["x"]) for r in texts.collect()) == [("1.0", "2.5"), ("2.0", None)]
    with pytest.raises(Exception):
        sources.read_header_csv(spark, str(tmp_path / "csv"), ["entity", "y"]).collect()
    sources.write_parquet(panel, str(tmp_path / "parquet"))
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2


def test_reviews_with_missing_fields(spark, tmp_path):
    lines = ['{"reviewerID":"u","asin":"i","overall":5.0,"verified":true,"reviewText":"ok"}', '{"reviewerID":"v","asin":"i","overall":1}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.option("compression", "gzip").text(str(tmp_path / "r"))
    rows = {r["reviewerID"]: r for r in sources.read_reviews(spark, str(tmp_path / "r")).collect()}
    assert rows["u"]["reviewText"] == "ok" and rows["v"]["reviewText"] is None and rows["v"]["overall"] == 1.0


def test_transactions_without_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1,2020-01-01,u1,3.5\n2,2020-01-02,u2,4\n")
    rows = sources.read_transactions(spark, str(tmp_path / "t.csv")).collect()
    assert [(r["user_id"], r["amount"]) for r in rows] == [("u1", 3.5), ("u2", 4.0)]
