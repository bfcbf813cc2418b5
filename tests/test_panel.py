import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumenfold.functions import clean
from lumenfold.operators import cleaning, panel
from lumenfold.plans import salted_join
from lumenfold.plans.panel import ENTITY_RULES, PANEL_RULES, prepared_panel


def test_numbers_from_text(spark):
    texts = ["1,234.5", "PrivacySuppressed", "", None, "NaN", "nan", "-3", "12 345", "1e3", " 7 ", "12N", "1n2", "N5", "5d", "1e999", "-1e999", "Infinity", ".5", "5.", "."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.coalesce(1).select(clean.to_number(F.col("t"))).collect()]
    assert got == [1234.5, None, None, None, None, None, -3.0, None, 1000.0, 7.0, *[None] * 7, 0.5, 5.0, None]
    blank = [r[0] for r in df.coalesce(1).select(clean.blank_to_null(F.col("t"))).collect()]
    assert blank[:5] == ["1,234.5", None, None, None, "NaN"]


def test_codes(spark):
    df = spark.createDataFrame([("01234-567",), ("x1234",), (None,)], "t string")
    assert [r[0] for r in df.coalesce(1).select(clean.code_prefix(F.col("t"))).collect()] == [1234, None, None]
    row = spark.range(1).select(clean.code_text(F.lit(1001.0)), clean.code_text(F.lit(1001.0), 5)).first()
    assert tuple(row) == ("1001", "01001")


def test_index_with_and_without_cap(spark):
    df = spark.createDataFrame([(10.0, 1000.0), (1.0, 1000.0), (1.0, 0.0)], "c double, p double")
    parts = {"high_school": F.lit(30.0), "some_college": F.lit(20.0), "bachelor": F.lit(10.0)}
    capped, open_ = (clean.completion_share(F.col("c"), F.col("p"), cap) for cap in (clean.COMPLETION_CAP, None))
    rows = df.coalesce(1).select(clean.composite_index(capped, parts), clean.composite_index(open_, parts)).collect()
    base = 0.4 * 30 + 0.6 * 20 + 0.8 * 10
    assert rows[0][0] == pytest.approx((0.493279 + base) / 100) and rows[0][1] == pytest.approx((1.0 + base) / 100)
    assert rows[1][0] == rows[1][1] == pytest.approx((0.1 + base) / 100)
    assert rows[2][0] is None


def test_bins_at_the_ends(spark):
    ends = clean.bin_ends()
    values = [0.0, ends[0], math.nextafter(ends[0], 0), ends[7], ends[-1], 0.9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.coalesce(1).select(clean.bin_number(F.col("v"))).collect()]
    assert got == [0, 1, 0, 8, 16, 16]


def test_sparse_columns_and_rows(spark):
    rows = [("1", "PrivacySuppressed", 1.0), ("2", "", math.nan), ("", "3", None), ("4", "4", 2.0)]
    df = spark.createDataFrame(rows, "a string, b string, c double")
    assert tuple(cleaning.null_ratios(df).first()) == (0.25, 0.25, 0.5)
    assert tuple(cleaning.null_ratios(df, sentinel=clean.SENTINEL).first()) == (0.25, 0.5, 0.5)
    assert cleaning.drop_sparse_columns(df, 0.25).columns == ["a", "b"]
    assert cleaning.drop_sparse_columns(df, 0.25, sentinel=clean.SENTINEL).columns == ["a"]
    assert cleaning.drop_sparse_rows(df, 2).count() == 2
    assert cleaning.drop_sparse_rows(df, 2, sentinel=None).count() == 2
    assert cleaning.drop_sparse_rows(df, 1, sentinel=None).count() == 2


def test_fill_from_whole(spark):
    df = spark.createDataFrame([(1, None, 4.0), (5, None, 6.0), (None, 9.0, None)], "p long, b double, h double")
    got = cleaning.fill_from_whole(df, {"p": F.max("p"), "b": F.avg("h")}).collect()
    assert sorted((r["p"], r["b"]) for r in got) == [(1, 5.0), (5, 5.0), (5, 9.0)]


@pytest.mark.parametrize("partitions", [1, 6])
def test_fill_group_mean_with_a_hot_group(spark, hot_pieces, partitions):
    data = [("hot" if n % 2 else f"g{n % 7}", n, None if n % 3 == 0 else float(n)) for n in range(80)]
    df = spark.createDataFrame(data + [("empty", 99, None), (None, 98, 1.0)], "g string, n long, v double")
    got = cleaning.fill_group_mean(df.repartition(partitions), "g", ["v"], ["n"]).toPandas().set_index("n")["v"]
    pdf = df.toPandas()
    want = pdf["v"].fillna(pdf.groupby("g")["v"].transform("mean"))
    pd.testing.assert_series_equal(got.sort_index(), pd.Series(want.values, index=pdf["n"]).sort_index(), check_names=False)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_plain_join(spark, hot_pieces, how):
    left = spark.createDataFrame([("hot" if n % 3 else f"k{n}", n) for n in range(90)] + [(None, 200)], "k string, n long")
    right = spark.createDataFrame([("hot", 1), ("k0", 2), ("k0", 3), ("other", 4)], "k string, v long")
    weights = left.groupBy("k").agg(F.count("*").alias("rows"))
    got = salted_join(left, right, "k", weights, ["n"], how)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_salted_join_spreads_the_hot_key(spark, hot_pieces):
    left = spark.createDataFrame([("hot", n) for n in range(300)], "k string, n long")
    right = spark.createDataFrame([("hot", 1)], "k string, v long")
    weights = left.groupBy("k").agg(F.count("*").alias("rows"))
    plan = salted_join(left, right, "k", weights, ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_piece" in plan and "xxhash64" in plan


def test_zip_join_fans_out_and_drops_bad_codes(spark, hot_pieces):
    rows = spark.createDataFrame([("01234-9", 1), ("01234", 2), (None, 3), ("abc", 4), ("09999", 5)], "z string, n long")
    codes = spark.createDataFrame([(1234, 10), (1234, 11)], "zip long, entity long")
    got = panel.join_zip_map(rows, codes, "z", ["n"]).collect()
    assert sorted((r["n"], r["entity"]) for r in got) == [(1, 10), (1, 11), (2, 10), (2, 11)]


def five_tables(spark):
    places = [(p, y, f"0000{p % 3}-1", f"{p * 100:,}", "5" if p % 4 else None, None) for p in range(12) for y in (2009, 2010, 2011)]
    places.append((50, 2010, "00001", "PrivacySuppressed", "5", "1"))
    places_df = spark.createDataFrame(places, "place long, year long, zip_text string, completions string, loans string, rare string")
    codes = spark.createDataFrame([(0, 100), (1, 101), (1, 102)], "zip long, entity long")
    cells = [(e, y) for e in (100, 101, 102, 103) for y in (2009, 2010, 2011)]
    unemployment = spark.createDataFrame([(e, y, str(e / 10)) for e, y in cells], "entity long, year long, unemployment string")
    education = spark.createDataFrame(
        [(e, y, "30", "20", None if e == 101 else "10") for e, y in cells],
        "entity long, year long, high_school string, some_college string, bachelor string",
    )
    population = spark.createDataFrame(
        [(e, y, None if y == 2011 else f"{e * 1000:,}") for e, y in cells[:-1]], "entity long, year long, population string"
    )
    return places_df, codes, unemployment, education, population


NUMBERS, EXTERNAL = ["completions", "loans", "rare"], ["unemployment", "high_school", "some_college", "bachelor", "population"]


def test_prepared_by_year(spark):
    got = prepared_panel(*five_tables(spark), NUMBERS, EXTERNAL, PANEL_RULES).toPandas()
    # loans (a quarter missing) and rare are dropped, 2009 is cut off, the sentinel row goes.
    assert "loans" not in got and "rare" not in got
    assert sorted(zip(got["entity"], got["year"])) == [(e, y) for e in (100, 101, 102) for y in (2010, 2011)]
    row = got[(got["entity"] == 101) & (got["year"] == 2011)].iloc[0]
    assert row["completions"] == pytest.approx((100 + 400 + 700 + 1000) / 4)
    assert row["population"] == 103000.0 and row["bachelor"] == 30.0
    assert row["share"] == pytest.approx(0.493279)
    assert row["index"] == pytest.approx((0.493279 + 0.4 * 30 + 0.6 * 20 + 0.8 * 30) / 100)


def test_prepared_by_entity(spark):
    got = prepared_panel(*five_tables(spark), NUMBERS, EXTERNAL, ENTITY_RULES).toPandas().set_index("entity")
    assert "rare" not in got and sorted(got.index) == [100, 101, 102]
    assert got.loc[100, "population"] == 100000.0 and got.loc[100, "bachelor"] == 10.0
    assert pd.isna(got.loc[101, "bachelor"]) and pd.isna(got.loc[101, "index"])
    share = got.loc[100, "completions"] * 100 / 100000.0
    assert got.loc[100, "index"] == pytest.approx((share + 12 + 12 + 8) / 100)


def test_entity_means_equal_those_over_the_product_of_years(spark):
    left = spark.createDataFrame([(1, 2010, 4.0), (1, 2011, 8.0), (2, 2010, 1.0)], "entity long, year long, a double")
    right = spark.createDataFrame([(1, 2010, 1.0), (1, 2012, 5.0), (2, 2010, 3.0)], "entity long, other_year long, b double")
    product = panel.entity_year_mean(panel.join_on_entity(left, right, "entity", ["year"]), ["a", "b"], ["entity"])
    apart = panel.join_panels(
        panel.entity_year_mean(left, ["a"], ["entity"]), panel.entity_year_mean(right, ["b"], ["entity"]), ["entity"]
    )
    assert sorted(product.collect()) == sorted(apart.collect()) == [(1, 6.0, 3.0), (2, 1.0, 3.0)]
