"""Cleaning of wide tables: sparse columns and rows, and filled nulls."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.functions.clean import SENTINEL, blank_to_null, is_blank, to_number
from lumenfold.plans import salted_join, stage


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that are not there are left alone."""
    return df.withColumnsRenamed(dict(names))


def clean_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn text columns into doubles, null where they hold no number (blanks, sentinel)."""
    return df.withColumns({c: to_number(F.col(c)) for c in columns})


def sentinel_to_null(df: DataFrame, columns: Sequence[str], sentinel: str = SENTINEL) -> DataFrame:
    """Null for empty text and the sentinel in text columns."""
    return df.withColumns({c: blank_to_null(F.col(c), sentinel) for c in columns})


def _is_missing(df: DataFrame, column: str, sentinel: str | None) -> Column:
    kind = df.schema[column].dataType.typeName()
    value = F.col(column)
    if kind == "string":
        return is_blank(value, sentinel)
    if kind in ("double", "float"):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def null_ratios(df: DataFrame, columns: Sequence[str] | None = None, sentinel: str | None = None) -> DataFrame:
    """One row: the share of missing values of each column, in one pass over all columns."""
    names = df.columns if columns is None else columns
    return df.agg(*[F.avg(_is_missing(df, c, sentinel).cast("double")).alias(c) for c in names])


def drop_sparse_columns(
    df: DataFrame, limit: float, columns: Sequence[str] | None = None, sentinel: str | None = None
) -> DataFrame:
    """Drop the columns whose share of missing values exceeds ``limit``.

    The schema depends on the data, so this runs one aggregation that returns one row.
    With ``sentinel`` the sentinel text counts as missing too.
    """
    ratios = null_ratios(df, columns, sentinel).first().asDict()
    return df.drop(*[c for c, ratio in ratios.items() if ratio is not None and ratio > limit])


def drop_sparse_rows(
    df: DataFrame, nulls: int = 5, columns: Sequence[str] | None = None, sentinel: str | None = SENTINEL
) -> DataFrame:
    """Keep rows with fewer than ``nulls`` missing values, the sentinel text among them."""
    names = df.columns if columns is None else columns
    missing = [_is_missing(df, c, sentinel).cast("int") for c in names]
    return df.where(sum(missing[1:], missing[0]) < nulls)


def fill_from_whole(df: DataFrame, fills: Mapping[str, Column]) -> DataFrame:
    """Fill nulls with a value aggregated from the whole table.

    ``fills`` maps a column to an aggregate such as ``F.max("population")``; all of
    them are computed in one pass and enter as one scalar.
    """
    scalars = df.agg(F.struct(*[a.cast(df.schema[c].dataType).alias(c) for c, a in fills.items()])).scalar()
    filled = df.withColumn("_fill", scalars)
    return filled.withColumns({c: F.coalesce(F.col(c), F.col(f"_fill.{c}")) for c in fills}).drop("_fill")


def fill_group_mean(df: DataFrame, group: str, columns: Sequence[str], spread: Sequence[str]) -> DataFrame:
    """Fill nulls with the mean of the column within the group.

    The input is computed once and staged. The means come from one pre-combined aggregate, staged with its row counts, and are
    joined back with hot groups split by the ``spread`` columns; no group is held by a single task. Rows
    without a group are a group of their own, which is split like any other.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = stage(df.withColumn("_group", key), "group_rows")
    means = [F.avg(c).alias(f"_mean_{c}") for c in columns]
    grouped = stage(rows.groupBy("_group").agg(F.count("*").alias("rows"), *means), "group_means")
    joined = salted_join(rows, grouped.drop("rows"), "_group", grouped.select("_group", "rows"), spread)
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_mean_{c}")) for c in columns})
    return filled.select(*df.columns)
