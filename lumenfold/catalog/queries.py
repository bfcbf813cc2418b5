"""One query per operator: (spark, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfold.catalog import inputs as i
from lumenfold.functions.clean import COMPLETION_CAP, SENTINEL
from lumenfold.operators import cleaning, corpus, panel, recommend, regression, sampling, similarity
from lumenfold.plans.panel import ENTITY_RULES, PANEL_RULES, add_index, prepared_panel
from lumenfold.plans.stage import scratch_path, stage
from lumenfold.sources import (
    check_reviews,
    check_transactions,
    checked_transaction_stream,
    join_laid_out,
    mean_laid_out,
    read_header_csv,
    read_numeric_csv,
    read_panel,
    read_reviews,
    read_transactions,
    stream_transactions,
    table,
    write_csv,
    write_panel,
    write_tuples,
)
from lumenfold.sources.files import TRANSACTIONS
from lumenfold.sources.tables import stream_table
from lumenfold.streaming import durable_hash_sample, run_to_end, stream_hash_sample, write_checked

SHARE, BUCKET, SALT = 0.02, 7, "s1|"
TARGET_QUERIES = [0, 3, 7]
TREND_ENTITIES, TREND_FEATURES = [1, 2, 3, 5], ["unemployment", "bachelor", "index"]


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column, so that results do not depend on the order of sums."""
    doubles = {f.name for f in df.schema if f.dataType == T.DoubleType()}
    return df.select(*[F.round(c, places).alias(c) if c in doubles else F.col(c) for c in df.columns])


# Text and sets


def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.word_count(i.documents(spark, folder))


def char_moments(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.letter_moments(i.documents(spark, folder))


def set_difference(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.set_difference(i.customers_of_year(spark, folder, 1995), i.customers_of_year(spark, folder, 1996))


def set_difference_distinct(spark: SparkSession, folder: str) -> DataFrame:
    r, s = i.customers_of_year(spark, folder, 1995), i.customers_of_year(spark, folder, 1996)
    return corpus.set_difference(r, s, mode="distinct")


def set_intersection(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.set_intersection(i.customers_of_year(spark, folder, 1995), i.customers_of_year(spark, folder, 1996))


def dense_to_coo(spark: SparkSession, folder: str) -> DataFrame:
    small_is_zero = F.transform("embedding", lambda v: F.when(F.abs(v) < 0.01, F.lit(0.0)).otherwise(v))
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").alias("label"), small_is_zero.alias("v"))
    square = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda row: F.slice("v", row * 8 + 1, F.lit(8)))
    return corpus.dense_to_coordinates(vectors, "label", square)


def top_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.top_tokens(i.documents(spark, folder))


def word_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    words, rows = corpus.counted_top(i.documents(spark, folder), carry=["doc_id"])
    found = corpus.counted_frequencies(rows, words, ["doc_id"])
    return rounded(found.select("doc_id", "word", "frequency"), 9)


# Samples


def sampled_keys(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sampled_keys(table(spark, folder, "orders"), "o_custkey", SHARE, SALT)


def sampled_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.sampled_rows(rows, "o_custkey", SHARE, SALT)


def sampled_rows_by_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.keep_keys(rows, sampling.sampled_keys(rows, "o_custkey", SHARE, SALT), "o_custkey")


def two_pass_sample(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sampling.two_pass_sample(table(spark, folder, "orders"), "o_custkey", "o_totalprice", SHARE, SALT), 4)


def hash_sample(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(sampling.hash_sample(table(spark, folder, "events"), "user_id", "value", SHARE, BUCKET))


def hash_sample_stream(spark: SparkSession, folder: str) -> DataFrame:
    stream = stream_table(spark, folder, "events")
    return rounded(run_to_end(stream_hash_sample(stream, "user_id", "value", SHARE, BUCKET)))


# Regression


def word_regression(spark: SparkSession, folder: str) -> DataFrame:
    tested = regression.word_regressions(i.reviews(spark, folder))
    return rounded(regression.both_ends(tested, "beta", ["word"]))


def word_regression_controlled(spark: SparkSession, folder: str) -> DataFrame:
    tested = regression.word_regressions(i.reviews(spark, folder), control="verified")
    return rounded(regression.both_ends(tested, "beta", ["word"]))


def word_regression_drop(spark: SparkSession, folder: str) -> DataFrame:
    """Only documents with a label."""
    tested = regression.word_regressions(i.reviews(spark, folder), missing="drop")
    return rounded(regression.both_ends(tested, "beta", ["word"]))


def word_regression_ols(spark: SparkSession, folder: str) -> DataFrame:
    """Full standard error, words in any case, p at most 1."""
    tested = regression.word_regressions(
        i.reviews(spark, folder), control="verified", se="ols", clip=True, case_fold=True
    )
    return rounded(regression.both_ends(tested, "beta", ["word"]))


def feature_regression(spark: SparkSession, folder: str) -> DataFrame:
    features = [*i.FEATURES, "share"]
    tested = regression.feature_regressions(i.indexed_cells(spark, folder), features, "index", include_target=True)
    return rounded(regression.both_ends(tested, "beta", ["feature"]))


# Ratings


def last_rating(spark: SparkSession, folder: str) -> DataFrame:
    return recommend.last_ratings(i.rating_events(spark, folder), i.RATING_ORDER)


def support_filter(spark: SparkSession, folder: str) -> DataFrame:
    return i.supported_ratings(spark, folder)


def item_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    ratings = i.supported_ratings(spark, folder)
    return rounded(recommend.item_neighbours(ratings, i.target_items(ratings)))


def item_neighbours_other(spark: SparkSession, folder: str) -> DataFrame:
    """The same without the target itself."""
    ratings = i.supported_ratings(spark, folder)
    return rounded(recommend.item_neighbours(ratings, i.target_items(ratings), include_self=False))


def all_item_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(recommend.all_item_neighbours(i.supported_ratings(spark, folder)))


def predict_ratings(spark: SparkSession, folder: str) -> DataFrame:
    ratings = i.supported_ratings(spark, folder)
    neighbours = recommend.item_neighbours(ratings, i.target_items(ratings))
    return rounded(recommend.predict_ratings(ratings, neighbours))


# Cleaning


def clean_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_numbers(i.places(spark, folder), i.PLACE_NUMBERS).drop("zip_text")


def null_ratios(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cleaning.null_ratios(i.places(spark, folder), i.PLACE_NUMBERS))


def drop_sparse_columns(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_sparse_columns(i.places(spark, folder), PANEL_RULES.null_limit, i.PLACE_NUMBERS)


def drop_sparse_columns_wide(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_sparse_columns(i.places(spark, folder), ENTITY_RULES.null_limit, i.PLACE_NUMBERS, SENTINEL)


def drop_sparse_rows(spark: SparkSession, folder: str) -> DataFrame:
    dense = cleaning.drop_sparse_rows(i.places(spark, folder), 2, i.PLACE_NUMBERS)
    return cleaning.sentinel_to_null(dense, i.PLACE_NUMBERS)


def drop_incomplete_rows(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_numbers(i.places(spark, folder), i.PLACE_NUMBERS).dropna("any")


def fill_global(spark: SparkSession, folder: str) -> DataFrame:
    _, education, population = i.external_tables(spark, folder)
    numbers = ["high_school", "some_college", "bachelor", "population"]
    cleaned = cleaning.clean_numbers(panel.join_panels(education, population), numbers)
    fills = {"population": F.max("population"), "bachelor": F.avg("high_school")}
    return rounded(cleaning.fill_from_whole(cleaned, fills))


def fill_group_mean(spark: SparkSession, folder: str) -> DataFrame:
    places = i.places(spark, folder).select("place", "line", "year", "zip_text", "completions", "loans")
    cleaned = cleaning.clean_numbers(places, ["completions", "loans"]).dropna(subset=["zip_text"])
    return rounded(cleaning.fill_group_mean(cleaned, "zip_text", ["completions", "loans"], ["place", "line", "year"]))


# Panels


def zip_join(spark: SparkSession, folder: str) -> DataFrame:
    return _zip_join(spark, folder, None)


def zip_join_cut(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a low limit, so that hot codes are cut in pieces."""
    return _zip_join(spark, folder, 20)


def _zip_join(spark: SparkSession, folder: str, piece_rows: int | None) -> DataFrame:
    places = i.places(spark, folder, i.FIRST_YEAR).select("place", "line", "year", "zip_text")
    return panel.join_zip_map(places, i.zip_map(spark, folder), "zip_text", ["place", "line"], i.ZIP_LENGTH, piece_rows)


def panel_mean(spark: SparkSession, folder: str) -> DataFrame:
    named = cleaning.rename(table(spark, folder, "lineitem"), {"l_suppkey": "entity", "l_shipdate": "shipped"})
    rows = named.select("entity", F.year("shipped").cast("long").alias("year"), "l_quantity", "l_extendedprice")
    return rounded(panel.entity_year_mean(rows, ["l_quantity", "l_extendedprice"]))


def entity_mean(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(panel.entity_year_mean(i.cells(spark, folder), i.FEATURES, ["entity"]))


def panel_join(spark: SparkSession, folder: str) -> DataFrame:
    unemployment, education, population = i.external_tables(spark, folder)
    joined = panel.join_panels(unemployment, panel.join_panels(education, population)).drop("some_college")
    return rounded(cleaning.clean_numbers(joined, ["unemployment", "high_school", "bachelor", "population"]))


def entity_join(spark: SparkSession, folder: str) -> DataFrame:
    cells = i.staged_cells(spark, folder)
    left = cells.select("entity", "year", "completions")
    right = cells.select("entity", F.col("year").alias("other_year"), "unemployment")
    return rounded(panel.join_on_entity(left, right, "entity", ["year"]))


def entity_join_grid(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a low limit, so that entities are cut on both sides."""
    cells = i.staged_cells(spark, folder)
    left = cells.select("entity", "year", "completions")
    right = cells.select("entity", F.col("year").alias("other_year"), "unemployment")
    return rounded(panel.join_on_entity_grid(left, right, "entity", ["year"], ["other_year"], 3))


def prepared_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return _prepared(spark, folder, PANEL_RULES)


def prepared_by_entity(spark: SparkSession, folder: str) -> DataFrame:
    return _prepared(spark, folder, ENTITY_RULES)


def _prepared(spark: SparkSession, folder: str, rules) -> DataFrame:
    return rounded(
        prepared_panel(
            i.places(spark, folder, i.FIRST_YEAR),
            i.zip_map(spark, folder),
            *i.external_tables(spark, folder),
            i.PLACE_NUMBERS,
            i.EXTERNAL_NUMBERS,
            rules,
            i.FIRST_YEAR,
            i.ZIP_LENGTH,
            ["place", "line"],
        )
    )


def composite_index(spark: SparkSession, folder: str) -> DataFrame:
    capped = i.indexed_cells(spark, folder, COMPLETION_CAP).select(
        "entity", "year", "share", F.col("index").alias("capped_index"), *i.FEATURES
    )
    both = add_index(capped.drop("share"), None)
    return rounded(both.select("entity", "year", "share", "index", "capped_index"))


def trend_series(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(panel.trend_series(i.indexed_cells(spark, folder), TREND_ENTITIES, TREND_FEATURES))


def index_bins(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(panel.index_bins(i.indexed_cells(spark, folder, year=i.SIMILARITY_YEAR), i.SIMILARITY_YEAR, width=5))


# Similarity


def endpoint_scale(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(similarity.to_long(i.scaled_cells(spark, folder), i.FEATURES))


def minmax_scale(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(similarity.to_long(i.scaled_cells(spark, folder, "minmax"), i.FEATURES))


def feature_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = similarity.to_vectors(similarity.to_long(i.scaled_cells(spark, folder), i.FEATURES))
    return _elements(vectors)


def gap_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Unit vectors of entities that lack some features, which count as zero."""
    scaled = similarity.scale_features(i.cells_with_gaps(spark, folder), i.FEATURES)
    return _elements(similarity.unit_vectors(scaled, i.FEATURES, missing="zero"))


def _elements(vectors: DataFrame) -> DataFrame:
    return rounded(vectors.select("entity", F.posexplode("vector").alias("place", "value")))


def pair_similarity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(similarity.extreme_pairs(i.entity_vectors(spark, folder), 10))


def pair_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(similarity.pair_lookup(i.entity_vectors(spark, folder), 3, 7))


def entity_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(similarity.entity_neighbours(i.entity_vectors(spark, folder), TARGET_QUERIES))


def all_entity_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(similarity.all_entity_neighbours(stage(i.entity_vectors(spark, folder), "vectors")))


# Files


def txn_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    return read_transactions(spark, _events_as_csv(spark, folder))


def txn_csv_stream(spark: SparkSession, folder: str) -> DataFrame:
    stream = stream_transactions(spark, _events_as_csv(spark, folder))
    return rounded(run_to_end(stream_hash_sample(stream, "user_id", "amount", SHARE, BUCKET)))


def _events_as_csv(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "transactions")
    write_tuples(table(spark, folder, "events").select("event_id", "event_type", "user_id", "value"), path)
    return path


def json_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "reviews")
    reviews = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("reviewerID"),
        F.col("source").alias("asin"),
        F.col("text").alias("reviewText"),
        F.col("n_chars").cast("double").alias("overall"),
        (F.col("lang") == "en").alias("verified"),
    )
    reviews.write.option("compression", "gzip").json(path)
    return read_reviews(spark, path)


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "panel")
    write_csv(rounded(i.indexed_cells(spark, folder)), path)
    return read_numeric_csv(spark, path, ["entity", "year", *i.FEATURES, "share", "index"])


def panel_file_regression(spark: SparkSession, folder: str) -> DataFrame:
    """From the written panel to the regressions."""
    tested = regression.feature_regressions(_panel_file(spark, folder), [*i.FEATURES, "share"], "index", include_target=True)
    return rounded(regression.both_ends(tested, "beta", ["feature"]))


def panel_file_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """From the written panel to the most and least similar entities of a year."""
    one_year = panel.of_year(_panel_file(spark, folder), i.SIMILARITY_YEAR)
    scaled = similarity.scale_features(one_year.withColumn("entity", F.col("entity").cast("long")), i.FEATURES)
    return rounded(similarity.extreme_pairs(similarity.unit_vectors(scaled, i.FEATURES), 10))


def _panel_file(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "panel")
    write_csv(i.indexed_cells(spark, folder), path)
    return read_numeric_csv(spark, path, ["entity", "year", *i.FEATURES, "share", "index"])


def header_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "places")
    places = i.places(spark, folder)
    write_csv(places, path)
    return read_header_csv(spark, path, places.columns)


def txn_csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with broken lines among them: every line is a good row or a bad line."""
    return _accounted(check_transactions(spark, _events_with_bad_lines(spark, folder)))


def txn_csv_quarantine_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a stream, one file per batch, with two outputs that stay."""
    stream = checked_transaction_stream(spark, _events_with_bad_lines(spark, folder), files_per_batch=1)
    return _accounted(write_checked(stream, TRANSACTIONS.names, scratch_path(spark, "checked"), scratch_path(spark, "state")))


def _accounted(found) -> DataFrame:
    return found.good.unionByName(found.bad.select("line", "reason"), allowMissingColumns=True)


def _events_with_bad_lines(spark: SparkSession, folder: str) -> str:
    """Lines whose number ends in 0, 1 and 2 have a word for the amount, two fields, and no amount."""
    path = scratch_path(spark, "lines")
    id, end = F.col("event_id").cast("string"), F.col("event_id") % 10
    fields = F.concat_ws(",", id, "event_type", F.col("user_id").cast("string"))
    line = F.when(end == 0, F.concat(fields, F.lit(",n/a"))).when(end == 1, F.concat_ws(",", id, "event_type"))
    line = line.when(end == 2, F.concat(fields, F.lit(","))).otherwise(F.concat_ws(",", fields, F.col("value").cast("string")))
    table(spark, folder, "events").repartition(3, "event_id").select(line.alias("value")).write.text(path)
    return path


def json_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews as JSON lines; every seventh is cut off in the middle, and those without a rating are bad, too."""
    path = scratch_path(spark, "json-lines")
    docs = table(spark, folder, "documents").select(
        "doc_id",
        F.to_json(
            F.struct(
                F.col("doc_id").cast("string").alias("reviewerID"),
                F.col("source").alias("asin"),
                F.when(F.col("doc_id") % 5 != 0, F.col("n_chars").cast("double")).alias("overall"),
            )
        ).alias("whole"),
    )
    line = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit('{"reviewerID":"'), F.col("doc_id").cast("string"))).otherwise(F.col("whole"))
    docs.select(line.alias("value")).write.option("compression", "gzip").text(path)
    found = check_reviews(spark, path, required=["overall"])
    good = found.good.select("reviewerID", "asin", "overall")
    # The text of a line without a rating depends on the writer; its reason does not.
    bad = found.bad.select("reason", F.when(F.col("reason") == "unreadable", F.col("line")).alias("line"))
    return good.unionByName(bad, allowMissingColumns=True)


def hash_sample_durable(spark: SparkSession, folder: str) -> DataFrame:
    """The one-pass sample of a stream of several files, from a result that outlives the driver."""
    path = scratch_path(spark, "event-files")
    events = table(spark, folder, "events").select("user_id", "value")
    events.repartition(4, "user_id").write.parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out, state = scratch_path(spark, "moments"), scratch_path(spark, "state")
    return rounded(durable_hash_sample(stream, "user_id", "value", out, state, SHARE, BUCKET))


LAID_YEARS = (1995, 1997)


def _laid_out(spark: SparkSession, panel: DataFrame) -> DataFrame:
    name = f"panel_{uuid.uuid4().hex}"
    write_panel(panel, name, buckets=8)
    return read_panel(spark, name, LAID_YEARS)


def panel_join_laid_out(spark: SparkSession, folder: str) -> DataFrame:
    """Some years of two panels, from tables by year and entity, joined without an exchange."""
    cells = i.staged_cells(spark, folder)
    left = _laid_out(spark, cells.select("entity", "year", "completions"))
    right = _laid_out(spark, cells.where("(entity + year) % 3 <> 0").select("entity", "year", "unemployment"))
    return rounded(join_laid_out(left, right).select("entity", "year", "completions", "unemployment"))


def panel_mean_laid_out(spark: SparkSession, folder: str) -> DataFrame:
    """Means per entity over some years of line items that are laid out by year and entity."""
    rows = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("entity"), F.year("l_shipdate").cast("long").alias("year"), "l_quantity", "l_extendedprice"
    )
    return rounded(mean_laid_out(_laid_out(spark, rows), ["l_quantity", "l_extendedprice"]))


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        word_count,
        char_moments,
        set_difference,
        set_difference_distinct,
        set_intersection,
        dense_to_coo,
        top_tokens,
        word_frequencies,
        sampled_keys,
        sampled_rows,
        sampled_rows_by_join,
        two_pass_sample,
        hash_sample,
        hash_sample_stream,
        word_regression,
        word_regression_controlled,
        word_regression_drop,
        word_regression_ols,
        feature_regression,
        last_rating,
        support_filter,
        item_neighbours,
        item_neighbours_other,
        all_item_neighbours,
        predict_ratings,
        clean_numeric,
        null_ratios,
        drop_sparse_columns,
        drop_sparse_columns_wide,
        drop_sparse_rows,
        drop_incomplete_rows,
        fill_global,
        fill_group_mean,
        zip_join,
        zip_join_cut,
        panel_mean,
        entity_mean,
        panel_join,
        entity_join,
        entity_join_grid,
        prepared_by_year,
        prepared_by_entity,
        composite_index,
        trend_series,
        index_bins,
        endpoint_scale,
        minmax_scale,
        feature_vectors,
        gap_vectors,
        pair_similarity,
        pair_lookup,
        entity_neighbours,
        all_entity_neighbours,
        txn_csv_scan,
        txn_csv_stream,
        json_scan,
        csv_round_trip,
        panel_file_regression,
        panel_file_pairs,
        header_csv_scan,
        txn_csv_quarantine,
        txn_csv_quarantine_stream,
        json_quarantine,
        hash_sample_durable,
        panel_join_laid_out,
        panel_mean_laid_out,
    )
}
