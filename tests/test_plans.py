"""Shapes of physical plans: what reaches the scan and what is shuffled."""

import re
import sys

import pytest
from pyspark.sql import functions as F

from lumenfold.catalog import inputs, queries
from lumenfold.plans import panel as panel_plan
from lumenfold.plans import grid_join, salted_join
from lumenfold.plans import stage as real_stage
from lumenfold.operators import corpus, panel, recommend, regression, sampling, similarity
from lumenfold.plans.skew import grid_side, hot_keys
from lumenfold.sources import table

stage_module = sys.modules["lumenfold.plans.stage"]
FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", text)]


def test_year_range_is_pushed_into_the_scan(spark):
    text = plan(inputs.customers_of_year(spark, FOLDER, 1995))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert scans(text) == [{"o_custkey", "o_orderdate"}]


def test_scans_read_only_the_needed_columns(spark):
    assert scans(plan(sampling.hash_sample(table(spark, FOLDER, "events"), "user_id", "value"))) == [{"user_id", "value"}]
    assert scans(plan(corpus.word_count(table(spark, FOLDER, "documents")))) == [{"text"}]
    for read in scans(plan(sampling.sampled_keys(table(spark, FOLDER, "orders"), "o_custkey", 0.02))):
        assert read == {"o_custkey"}


@pytest.mark.parametrize("name", ["word_count", "char_moments", "set_difference", "set_intersection", "set_difference_distinct"])
def test_one_combined_shuffle(spark, name):
    text = plan(queries.ALL[name](spark, FOLDER))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("HashAggregate") == 2


def test_samples_filter_without_a_join(spark):
    text = plan(sampling.sampled_rows(table(spark, FOLDER, "orders"), "o_custkey", 0.02))
    outer = text.split("Subquery")[0]
    assert "Join" not in outer.split("ReadSchema")[0]


def test_top_k_per_query_is_limited_before_the_shuffle(spark):
    vectors = spark.range(50).select(F.col("id").alias("entity"), F.array(F.col("id") * 1.0, F.lit(1.0)).alias("vector"))
    text = plan(similarity.entity_neighbours(vectors, [1, 2], k=5))
    assert text.count("WindowGroupLimit") == 2
    assert plan(similarity._k_per_vector(vectors, 3)).count("WindowGroupLimit") == 2


def test_feature_moments_are_combined_before_the_shuffle(spark):
    df = spark.range(20).select((F.col("id") * 1.0).alias("a"), (F.col("id") * F.col("id") * 1.0).alias("y"))
    text = plan(regression.feature_regressions(df, ["a"], "y"))
    assert text.count("partial_covar_pop") >= 1 and text.count("Exchange hashpartitioning") == 1


def test_last_rating_keeps_one_shuffle(spark):
    df = spark.createDataFrame([(1, 2, 3.0, 4)], "user long, item long, rating double, moment long")
    assert plan(recommend.last_ratings(df, ["moment"])).count("Exchange") == 1


def test_words_are_counted_inside_the_row(spark):
    docs = table(spark, FOLDER, "documents").select("doc_id", "text")
    words = spark.createDataFrame([("the",)], "word string")
    text = plan(corpus.word_frequencies(docs, words))
    assert "Exchange hashpartitioning" not in text and text.count("regexp_extract_all") == 1


@pytest.mark.parametrize(
    "name", "zip_join prepared_by_year prepared_by_entity index_bins endpoint_scale feature_vectors pair_lookup entity_neighbours".split()
)
def test_date_ranges_reach_the_scan(spark, name, monkeypatch):
    seen = []
    monkeypatch.setattr(stage_module, "stage", lambda df, label: seen.append(plan(df)) or real_stage(df, label))
    monkeypatch.setattr(inputs, "stage", stage_module.stage)
    monkeypatch.setattr(panel_plan, "stage", stage_module.stage)
    text = plan(queries.ALL[name](spark, FOLDER))
    assert any("GreaterThanOrEqual(l_shipdate" in t for t in [text, *seen])


@pytest.mark.parametrize("name", ["word_count", "top_tokens", "clean_numeric", "char_moments", "drop_sparse_rows"])
def test_rows_are_not_dealt_out_unasked(spark, name):
    assert "RoundRobin" not in plan(queries.ALL[name](spark, FOLDER))


def test_no_count_before_a_join_that_broadcasts(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    rows = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    broken = rows.groupBy("k").agg(F.raise_error("counted").alias("rows"))
    assert salted_join(rows, small, "k", broken, ["id"]).count() == 1000


def hot_sides(spark):
    left = spark.range(600).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("k"), F.col("id").alias("a"))
    right = spark.range(500).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 45).alias("k"), F.col("id").alias("b"))
    return left, right


def sizes(df):
    return df.groupBy("k").agg(F.count("*").alias("rows"))


@pytest.mark.parametrize("piece_rows", [None, 1, 20, 10_000])
def test_grid_join_equals_the_plain_join(spark, piece_rows):
    left, right = hot_sides(spark)
    got = grid_join(left, right, "k", sizes(left), sizes(right), ["a"], ["b"], piece_rows)
    assert sorted(map(tuple, got.select("k", "a", "b").collect())) == sorted(map(tuple, left.join(right, "k").select("k", "a", "b").collect()))


def test_no_cell_of_the_grid_reads_a_whole_side(spark):
    left, right = hot_sides(spark)
    cells = {"_row": hot_keys(sizes(left), "k", 20), "_column": hot_keys(sizes(right), "k", 20)}
    sides = grid_side(left, "k", cells, "_row", ["a"]), grid_side(right, "k", cells, "_column", ["b"])
    most = [s.groupBy("k", "_row", "_column").count().agg({"count": "max"}).first()[0] for s in sides]
    whole = [sizes(s).agg({"rows": "max"}).first()[0] for s in (left, right)]
    assert max(most) <= 45 and min(whole) >= 160


def test_entities_hot_on_both_sides(spark):
    left, right = hot_sides(spark)
    got = panel.join_on_entity_grid(left, right, "k", ["a"], ["b"], 25)
    assert got.count() == panel.join_on_entity(left, right, "k", ["a"]).count()
