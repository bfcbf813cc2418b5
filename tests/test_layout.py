import uuid

import pytest
from pyspark.sql import functions as F

from lumenfold.sources import layout


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def panels(spark):
    """Two panels with some entities and years missing, laid out in four buckets."""
    cells = spark.range(40).select((F.col("id") % 10).alias("entity"), (2010 + F.col("id") % 4).alias("year")).distinct()
    a = cells.where("entity <> 3").withColumn("x", F.col("entity") * 1.0)
    b = cells.where("year <> 2011").withColumn("y", F.col("year") * 2.0)
    names = [f"panel_{uuid.uuid4().hex}" for _ in range(2)]
    laid = [layout.write_panel(p, n, buckets=4) for p, n in zip((a, b), names, strict=True)]
    yield (a, b), laid, names
    for name in names:
        layout.drop_panel(spark, name)


def rows(df):
    return sorted(map(tuple, df.select("entity", "year", "x", "y").collect()))


def test_panel_join_needs_no_exchange(panels):
    (a, b), (left, right), _ = panels
    joined = layout.join_laid_out(left, right)
    assert "Exchange" not in plan(joined)
    assert rows(joined) == rows(a.join(b, ["entity", "year"]))


def test_means_need_no_exchange(panels):
    (a, _), (left, _), _ = panels
    mean = layout.mean_laid_out(left, ["x"])
    assert "Exchange" not in plan(mean) and mean.count() == a.count()


def test_only_the_asked_years_are_read(spark, panels):
    (a, b), _, names = panels
    left, right = (layout.read_panel(spark, n, (2012, 2013)) for n in names)
    text = plan(left)
    assert "PartitionFilters: [isnotnull(year" in text and "2012" in text.split("PartitionFilters")[1].split("]")[0]
    assert len(left.inputFiles()) < len(layout.read_panel(spark, names[0]).inputFiles())
    joined = layout.join_laid_out(left, right)
    assert "Exchange" not in plan(joined)
    assert rows(joined) == rows(a.join(b, ["entity", "year"]).where("year >= 2012"))


def test_one_file_per_bucket_and_year(spark, panels):
    (a, _), (left, _), _ = panels
    per = left.select("year", F.input_file_name().alias("f")).distinct().groupBy("year").count().collect()
    assert all(r["count"] <= 4 for r in per)
