"""Joins, means and chart series of (entity, year) panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.functions.clean import bin_number, code_prefix, code_text
from lumenfold.plans import grid_join, salted_join


def of_year(panel: DataFrame, year: int, column: str = "year") -> DataFrame:
    """Rows of one year."""
    return panel.where(F.col(column) == year)


def since_year(panel: DataFrame, year: int, column: str = "year") -> DataFrame:
    """Rows from a year on."""
    return panel.where(F.col(column) >= year)


def of_entities(panel: DataFrame, entities: Sequence, column: str = "entity") -> DataFrame:
    """Rows of the given entities."""
    return panel.where(F.col(column).isin(list(entities)))


def entity_year_mean(rows: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("entity", "year")) -> DataFrame:
    """Mean of each column per key."""
    return rows.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def join_panels(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("entity", "year")) -> DataFrame:
    """Inner join of two panels on entity and year."""
    return a.join(b, list(keys), "inner")


def join_on_entity(a: DataFrame, b: DataFrame, entity: str, spread: Sequence[str]) -> DataFrame:
    """Inner join on the entity alone: the years of both sides multiply.

    A hot entity of ``a`` is split by the ``spread`` columns; of the tasks that join it, each
    holds a piece of ``a`` and reads the rows of ``b`` for that entity.
    """
    rows = a.groupBy(entity).agg(F.count("*").alias("rows"))
    return salted_join(a, b, entity, rows, spread)


def join_on_entity_grid(
    a: DataFrame, b: DataFrame, entity: str, spread_a: Sequence[str], spread_b: Sequence[str], piece_rows: int | None = None
) -> DataFrame:
    """The same where an entity can be hot on both sides: its product is dealt out cell by cell."""
    sizes = [side.groupBy(entity).agg(F.count("*").alias("rows")) for side in (a, b)]
    return grid_join(a, b, entity, *sizes, spread_a, spread_b, piece_rows)


def join_zip_map(
    rows: DataFrame, zip_map: DataFrame, zip_text: str, spread: Sequence[str], length: int = 5, piece_rows: int | None = None
) -> DataFrame:
    """Attach the entities of a postal code; a code of several entities repeats its rows.

    The code is the leading ``length`` characters of ``zip_text``; rows without a whole
    number there are dropped. ``zip_map`` has (``zip``, further columns).
    """
    coded = rows.withColumn("zip", code_prefix(F.col(zip_text), length)).dropna(subset=["zip"])
    counts = coded.groupBy("zip").agg(F.count("*").alias("rows"))
    return salted_join(coded, zip_map, "zip", counts, spread, piece_rows=piece_rows)


def trend_series(
    panel: DataFrame, entities: Sequence, features: Sequence[str], entity: str = "entity", year: str = "year"
) -> DataFrame:
    """(entity, year, feature, value) points of a line chart."""
    chosen = of_entities(panel, entities, entity).select(entity, year, *[F.col(f).cast("double") for f in features])
    return chosen.unpivot([entity, year], list(features), "feature", "value")


def index_bins(panel: DataFrame, year: int, index: str = "index", entity: str = "entity", width: int | None = None) -> DataFrame:
    """(entity code as text, index, bin) of one year, as a binned map needs them."""
    return of_year(panel, year).select(
        code_text(F.col(entity), width).alias("code"), F.col(index), bin_number(F.col(index)).alias("bin")
    )
