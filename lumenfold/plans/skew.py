"""Equi-joins that split hot keys over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot above 1/SHARES of the left rows, so there are fewer than SHARES
# hot keys and fewer than 2 * SHARES pieces, whatever the size of the data. Keys
# below MIN_PIECE_ROWS fit a task anyway.
SHARES = 1024
MIN_PIECE_ROWS = 1_000_000


def broadcasts(df: DataFrame) -> bool:
    """Whether Spark's size estimate of ``df`` is below its own limit for broadcasts."""
    session = df.sparkSession._jsparkSession.sessionState()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return size <= session.conf().autoBroadcastJoinThreshold()


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    weights: DataFrame,
    spread: Sequence[str],
    how: str = "inner",
    piece_rows: int | None = None,
) -> DataFrame:
    """Join ``left`` and ``right`` on ``on``, cutting each hot key of ``left`` in pieces.

    ``weights`` has one row per key of ``left``: (``on``, ``rows``). It is aggregated right
    away, unless Spark will broadcast ``right``, when no key is hot; without a hot key the
    result is the plain join. The columns in ``spread``
    choose the piece by hash, so a recomputed task puts a row into the same piece again.
    ``right`` rows of a hot key are repeated once per piece. A piece has ``piece_rows`` rows or
    a SHARES-th of all, whichever is more; if it is given, the keys are counted in any case. ``how`` is ``inner``, ``left``
    or ``left_semi``.
    """
    hot = None if piece_rows is None and broadcasts(right) else hot_keys(weights, on, piece_rows)
    if hot is None:
        return left.join(right, on, how)
    piece = F.pmod(F.xxhash64(*spread), F.col("_pieces"))
    cut_left = left.join(hot, on, "left").withColumn("_piece", F.coalesce(piece, F.lit(0))).drop("_pieces")
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1)) - 1)
    cut_right = right.join(hot, on, "left").withColumn("_piece", F.explode(copies)).drop("_pieces")
    return cut_left.join(cut_right, [on, "_piece"], how).drop("_piece")


def grid_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_weights: DataFrame,
    right_weights: DataFrame,
    left_spread: Sequence[str],
    right_spread: Sequence[str],
    piece_rows: int | None = None,
) -> DataFrame:
    """Inner join on ``on``, for keys that may be hot on both sides.

    The rows of a hot key are cut in pieces on either side, and each cell (left piece, right piece) is joined
    by itself: a left row is repeated once per right piece and the other way round. So no task reads a
    whole side of a key, and the product of the two sides is spread over all cells. Weights, spread and pieces are
    as in :func:`salted_join`, for each side.
    """
    cells = {"_row": hot_keys(left_weights, on, piece_rows), "_column": hot_keys(right_weights, on, piece_rows)}
    if not any(hot is not None for hot in cells.values()):
        return left.join(right, on)
    return grid_side(left, on, cells, "_row", left_spread).join(
        grid_side(right, on, cells, "_column", right_spread), [on, "_row", "_column"]
    ).drop("_row", "_column")


def grid_side(rows: DataFrame, on: str, cells: dict[str, DataFrame | None], own: str, spread: Sequence[str]) -> DataFrame:
    """``rows`` with their place in the grid: by hash along their ``own`` axis, repeated along the other."""
    for axis, hot in cells.items():
        if hot is None:
            rows = rows.withColumn(axis, F.lit(0).cast("long"))
            continue
        marked = rows.join(hot, on, "left")
        pieces = F.coalesce("_pieces", F.lit(1))
        if axis == own:
            place = F.pmod(F.xxhash64(*spread), pieces)
        else:
            place = F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))
        rows = marked.withColumn(axis, place).drop("_pieces")
    return rows


def hot_keys(weights: DataFrame, on: str, piece_rows: int | None = None) -> DataFrame | None:
    """(key, ``_pieces``) of the keys above the share limit, for broadcast; None if there are none.

    Brings two numbers to the driver, and fewer than SHARES keys if some are hot.
    """
    size = weights.agg(F.sum("rows").alias("total"), F.max("rows").alias("largest")).first()
    piece_rows = max((size["total"] or 0) / SHARES, float(MIN_PIECE_ROWS if piece_rows is None else piece_rows))
    if (size["largest"] or 0) <= piece_rows:
        return None
    hot = weights.where(F.col(on).isNotNull() & (F.col("rows") > piece_rows))
    rows = hot.select(on, F.ceil(F.col("rows") / F.lit(piece_rows)).alias("_pieces")).collect()
    schema = T.StructType([weights.schema[on], T.StructField("_pieces", T.LongType())])
    return F.broadcast(weights.sparkSession.createDataFrame(rows, schema)) if rows else None
