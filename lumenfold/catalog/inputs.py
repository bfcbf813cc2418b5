"""The given tables seen as the inputs of the operators.

reviews       documents with their labels: rating = quality, verified = toxic
transactions  orders (customer, total price) and events (user, value)
ratings       line items: user = customer, item = part, rating = quantity
cells         supplier and ship year as an (entity, year) panel
places        line items as a raw place table with gaps, sentinels and comma numbers
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.functions.clean import COMPLETION_CAP
from lumenfold.operators.recommend import last_ratings, support_filter
from lumenfold.operators.similarity import scale_features, unit_vectors
from lumenfold.plans.panel import add_index
from lumenfold.plans.stage import stage
from lumenfold.sources import table

# Set by the bench and local checks: the test tables have one split each.
PARTITIONS: int | None = None
FEATURES = ["completions", "population", "high_school", "some_college", "bachelor", "unemployment"]
PLACE_NUMBERS = ["completions", "tuition", "loans", "rare"]
EXTERNAL_NUMBERS = ["unemployment", "high_school", "some_college", "bachelor", "population"]
# Texts that look like numbers but are none.
ODD_NUMBERS = ["12N", "40N", "1n2", "N5", "5d", "1e999", "Infinity"]
ZIP_LENGTH = 9
FIRST_YEAR = 1997
SIMILARITY_YEAR = 1998
RATING_ORDER = ["o_orderdate", "l_orderkey", "l_linenumber", "l_shipdate", "rating"]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents", PARTITIONS)


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Every document; those without a label have neither rating nor mark."""
    docs = documents(spark, folder).select("doc_id", "text")
    labels = table(spark, folder, "labels")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", "text", F.col("quality").alias("rating"), F.col("toxic").alias("verified")
    )


def customers_of_year(spark: SparkSession, folder: str, year: int) -> DataFrame:
    """Customer of every order of a year; the range of dates is pushed into the scan."""
    ordered = F.col("o_orderdate")
    orders = table(spark, folder, "orders").where((ordered >= date(year, 1, 1)) & (ordered < date(year + 1, 1, 1)))
    return orders.select(F.col("o_custkey").alias("element"))


def rating_events(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, folder, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        F.col("l_quantity").alias("rating"),
        "o_orderdate",
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
    )


def supported_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Filtered ratings, staged because the recommendation reads them several times."""
    ratings = stage(last_ratings(rating_events(spark, folder), RATING_ORDER), "ratings")
    return stage(support_filter(ratings), "supported")


def target_items(ratings: DataFrame) -> DataFrame:
    return ratings.select("item").distinct().orderBy("item").limit(2)


def cells(spark: SparkSession, folder: str, year: int | None = None) -> DataFrame:
    """All cells, or those of one year, whose range of dates is pushed into the scan."""
    lines = table(spark, folder, "lineitem")
    if year is not None:
        lines = lines.where((F.col("l_shipdate") >= date(year, 1, 1)) & (F.col("l_shipdate") < date(year + 1, 1, 1)))
    return lines.groupBy(
        F.col("l_suppkey").alias("entity"), F.year("l_shipdate").cast("long").alias("year")
    ).agg(
        F.sum((F.col("l_returnflag") == "R").cast("double")).alias("completions"),
        (F.sum("l_quantity") * 2.5).alias("population"),
        (F.avg("l_discount") * 600.0).alias("high_school"),
        (F.avg("l_tax") * 750.0).alias("some_college"),
        (F.avg("l_quantity") * 0.8).alias("bachelor"),
        (F.avg("l_extendedprice") / 1000.0).alias("unemployment"),
    )


def staged_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The same, staged for queries that use the panel several times."""
    return stage(cells(spark, folder), "cells")


def indexed_cells(
    spark: SparkSession, folder: str, cap: float | None = COMPLETION_CAP, year: int | None = None
) -> DataFrame:
    return add_index(cells(spark, folder, year), cap)


def places(spark: SparkSession, folder: str, since: int | None = None) -> DataFrame:
    """Line items as places, all or from a year on, with numbers, gaps and texts that are no numbers."""
    lines = table(spark, folder, "lineitem", PARTITIONS)
    if since is not None:
        lines = lines.where(F.col("l_shipdate") >= date(since, 1, 1))
    odd = F.array(*[F.lit(x) for x in ODD_NUMBERS])
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    price = F.round("l_extendedprice").cast("long")
    discount = F.round(F.col("l_discount") * 100).cast("long").cast("string")
    quantity = F.col("l_quantity").cast("long").cast("string")
    return lines.select(
        F.col("l_orderkey").alias("place"),
        F.col("l_linenumber").alias("line"),
        F.year("l_shipdate").cast("long").alias("year"),
        F.when(k % 23 != 0, F.concat(F.lpad(F.col("l_suppkey").cast("string"), 9, "0"), F.lit("-0001"))).alias("zip_text"),
        F.when(k % 29 == 0, "PrivacySuppressed")
        .when(k % 43 == 0, F.get(odd, (k % len(ODD_NUMBERS)).cast("int")))
        .when(k % 31 != 0, F.format_number(price, 0))
        .alias("completions"),
        F.when(k % 37 == 0, "").otherwise(discount).alias("tuition"),
        F.when(k % 3 != 0, quantity).alias("loans"),
        F.when(k % 2 != 0, quantity).alias("rare"),
    )


def zip_map(spark: SparkSession, folder: str) -> DataFrame:
    """Postal code to entities: up to three entities per code."""
    key = F.col("s_suppkey")
    codes = F.array_distinct(F.array(key, F.floor(key / 2)))
    return table(spark, folder, "supplier").select(F.explode(codes).alias("zip"), key.alias("entity"))


def external_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Unemployment, education and population, as text with gaps."""
    base = staged_cells(spark, folder)
    text = lambda c: F.col(c).cast("string").alias(c)
    unemployment = base.select("entity", "year", text("unemployment"))
    bachelor = F.when((F.col("entity") + F.col("year")) % 11 != 0, F.col("bachelor").cast("string"))
    education = base.select("entity", "year", text("high_school"), text("some_college"), bachelor.alias("bachelor"))
    people = F.format_number(F.floor("population"), 0)
    population = base.select(
        "entity", "year", F.when((F.col("entity") * 3 + F.col("year")) % 13 != 0, people).alias("population")
    )
    return unemployment, education, population


def scaled_cells(spark: SparkSession, folder: str, mode: str = "endpoint") -> DataFrame:
    """One year of the panel, scaled. The year is staged: its ends and its rows are read."""
    return scale_features(stage(cells(spark, folder, SIMILARITY_YEAR), "cells"), FEATURES, mode=mode)


def cells_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """One year of the panel; the smallest and other entities lack one feature, every eleventh another."""
    one_year = stage(cells(spark, folder, SIMILARITY_YEAR), "cells")
    return one_year.withColumns(
        {
            "bachelor": F.when(F.col("entity") % 5 > 1, F.col("bachelor")),
            "high_school": F.when(F.col("entity") % 11 > 0, F.col("high_school")),
        }
    )


def entity_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return unit_vectors(scaled_cells(spark, folder), FEATURES)
