"""From five raw tables to a prepared (entity, year) panel with its composite index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.functions.clean import COMPLETION_CAP, INDEX_WEIGHTS, SENTINEL, completion_share, composite_index
from lumenfold.operators import cleaning, panel as pn
from lumenfold.plans.stage import stage


@dataclass(frozen=True)
class Rules:
    """Where the two known ways of preparing the panel differ.

    null_limit: share of missing values above which a column goes.
    sentinel_counts_as_null: whether the sentinel counts as missing for that.
    row_nulls: rows with this many missing values or more go (None: all stay).
    drop_incomplete: drop rows with any missing value. Otherwise missing values take
        the mean of their entity, which leaves that mean as it is, so they are skipped.
    cap: upper end of the completion share (None: open).
    by_year: one row per (entity, year), tables joined on both; else one row per entity.
    """

    null_limit: float
    sentinel_counts_as_null: bool
    row_nulls: int | None
    drop_incomplete: bool
    cap: float | None
    by_year: bool


# The thresholds of the two preparations.
PANEL_RULES = Rules(
    null_limit=0.10,
    sentinel_counts_as_null=False,
    row_nulls=5,
    drop_incomplete=True,
    cap=COMPLETION_CAP,
    by_year=True,
)
ENTITY_RULES = Rules(
    null_limit=0.4,
    sentinel_counts_as_null=True,
    row_nulls=None,
    drop_incomplete=False,
    cap=None,
    by_year=False,
)
FIRST_YEAR = 2010


def external_panel(unemployment: DataFrame, education: DataFrame, population: DataFrame, numbers: Sequence[str]) -> DataFrame:
    """Unemployment, education and population joined per (entity, year) and cleaned.

    Missing populations take the largest one, missing bachelor shares the mean of the
    high-school share; rows with any other null are dropped.
    """
    joined = pn.join_panels(unemployment, pn.join_panels(education, population))
    cleaned = cleaning.clean_numbers(joined, numbers)
    filled = cleaning.fill_from_whole(
        cleaned, {"population": F.max("population"), "bachelor": F.avg("high_school")}
    )
    return filled.dropna("any")


def place_panel(
    places: DataFrame,
    zip_map: DataFrame,
    numbers: Sequence[str],
    rules: Rules,
    first_year: int = FIRST_YEAR,
    zip_length: int = 5,
    place_key: Sequence[str] = ("place",),
) -> DataFrame:
    """Places (one row per place and year, text numbers) as a mean per entity.

    The place table is joined to the postal-code map, cut to ``first_year`` and later,
    freed of sparse columns, cleaned, and averaged per (entity, year) or per entity.
    """
    coded = pn.join_zip_map(places, zip_map, "zip_text", [*place_key, "year"], zip_length)
    # Staged: the null ratios decide the schema, so the join result is read twice.
    recent = stage(pn.since_year(coded, first_year), "places")
    sentinel = SENTINEL if rules.sentinel_counts_as_null else None
    dense = cleaning.drop_sparse_columns(recent, rules.null_limit, numbers, sentinel)
    kept = [c for c in numbers if c in dense.columns]
    if rules.row_nulls is not None:
        dense = cleaning.drop_sparse_rows(dense, rules.row_nulls)
    cleaned = cleaning.clean_numbers(dense, kept)
    if rules.drop_incomplete:
        cleaned = cleaned.dropna("any")
    keys = ["entity", "year"] if rules.by_year else ["entity"]
    return pn.entity_year_mean(cleaned, kept, keys)


def add_index(
    panel: DataFrame,
    cap: float | None,
    weights: Mapping[str, float] = INDEX_WEIGHTS,
    completions: str = "completions",
    population: str = "population",
) -> DataFrame:
    """Add ``share`` (100 * completions / population) and the composite ``index``."""
    with_share = panel.withColumn("share", completion_share(F.col(completions), F.col(population), cap))
    parts = {name: F.col(name) for name in weights}
    return with_share.withColumn("index", composite_index(F.col("share"), parts, weights))


def prepared_panel(
    places: DataFrame,
    zip_map: DataFrame,
    unemployment: DataFrame,
    education: DataFrame,
    population: DataFrame,
    place_numbers: Sequence[str],
    external_numbers: Sequence[str],
    rules: Rules = PANEL_RULES,
    first_year: int = FIRST_YEAR,
    zip_length: int = 5,
    place_key: Sequence[str] = ("place",),
) -> DataFrame:
    """The whole preparation: external panel, place panel, their join, and the index.

    With ``by_year`` off every table is averaged per entity before the join. Joining the
    yearly rows first would repeat each of them equally often within an entity, so the
    means are the same and the product of the years is never built.
    """
    inner = place_panel(places, zip_map, place_numbers, rules, first_year, zip_length, place_key)
    if rules.by_year:
        outer = external_panel(unemployment, education, population, external_numbers)
        joined = pn.join_panels(inner, outer)
    else:
        joined = inner
        for table in (unemployment, education, population):
            numbers = [c for c in external_numbers if c in table.columns]
            means = pn.entity_year_mean(cleaning.clean_numbers(table, numbers), numbers, ["entity"])
            joined = pn.join_panels(joined, means, ["entity"])
    return add_index(joined, rules.cap)
