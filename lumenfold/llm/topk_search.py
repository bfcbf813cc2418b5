"""Exact top-k by inner product with block-at-a-time pruning.

Every component x of a vector becomes floor(64 * x); a dimension is a term. Vectors are cut
by ranges of their id into groups, and each group into blocks of ``BLOCK`` rows with the largest and
smallest value of each term. The sum over the terms of query value times block maximum
(minimum, where the query value is negative) bounds every score in a block. A query takes
the blocks of a group in the order of their bounds, scores each through its rows, and stops
at the first bound below its k-th score so far.

Groups come in rounds, each with as many as all before it. A round starts from the k-th
scores of the rounds before, so that few rows beyond k per query leave a task, however many
groups there are. A task holds one group of vectors and one of queries. Each has a
fixed size; vectors are shipped once per group of queries. The index is a written table.

Ties go to the smaller id, then to the row that comes first. Rows with equal ids are different rows: each is
a query, and a candidate for the others. Vectors that are null or hold null or non-finite
components, and rows without an id, take no part. A shorter vector is filled with zeros. Sums are
exact for any finite component; those beyond the range of long are cut to it after ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lumenfold.plans.stage import stage

K = 20
EVERY = 20
SCALE = 64
BLOCK = 256
GROUP = 16_384
QUERIES = 4_096
FIRST = 8
AT_ONCE = 4
BLOCK_ROW = "grp long, ids binary, rows binary, kind string, width int, cells binary"
EXACT = float(1 << 53)


def pack(cells: np.ndarray) -> tuple[str, bytes]:
    """The cells in the smallest of three types that holds them all."""
    top = float(np.abs(cells).max(initial=0))
    kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8"
    return kind, cells.astype(kind).tobytes()


def unpack(row) -> np.ndarray:
    cells = np.frombuffer(row.cells, row.kind)
    return cells.reshape(-1, row.width) if row.width else np.zeros((len(row.ids) // 8, 0))


def index(vectors: DataFrame, scale: int = SCALE, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """The forward index: one row per block of vectors that are neighbours by id."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = plain.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    rows = stage(whole.withColumn("row", F.monotonically_increasing_id()), "vectors")
    groups = max(1, -(-rows.count() // group))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        out = []
        for at in range(0, table.num_rows, block):
            part = table.slice(at, block)
            vecs = part.column("embedding").combine_chunks()
            sizes = np.diff(vecs.offsets.to_numpy())
            cells = np.zeros((len(vecs), sizes.max(initial=0)))
            cells[np.arange(cells.shape[1]) < sizes[:, None]] = vecs.flatten().to_numpy()
            kind, packed = pack(np.floor(scale * cells))
            ids, row = (part.column(c).to_numpy().astype("<i8").tobytes() for c in ("vec_id", "row"))
            out.append((ids, row, kind, cells.shape[1], packed))
        names = ["ids", "rows", "kind", "width", "cells"]
        kinds = [pa.binary(), pa.binary(), pa.string(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    ranged = rows.repartitionByRange(groups, "vec_id", "row")
    blocks = ranged.mapInArrow(cut, "ids binary, rows binary, kind string, width int, cells binary")
    return stage(blocks.withColumn("grp", F.spark_partition_id().cast("long")), "blocks")


def query_rows(blocks: DataFrame, every: int = EVERY, size: int = QUERIES) -> DataFrame:
    """(part, query_id, row, kind, width, cells): every vector whose id ``every`` divides, dealt into parts of ``size``."""

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for b in frame.itertuples():
                ids, rows, cells = np.frombuffer(b.ids, "<i8"), np.frombuffer(b.rows, "<i8"), unpack(b)
                at = np.flatnonzero(ids % every == 0)
                packed = [cells[i].tobytes() for i in at]
                yield pd.DataFrame({"query_id": ids[at], "row": rows[at], "kind": b.kind, "width": b.width, "cells": packed})

    rows = blocks.mapInPandas(pick, "query_id long, row long, kind string, width int, cells binary")
    parts = max(1, -(-rows.count() // size))
    return stage(rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts))), "queries"), parts


def exact_product(cells: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products without rounding: in doubles where they hold the sums, else in whole numbers of any size."""
    if float(np.abs(cells).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(len(query), 1) < EXACT:
        return cells @ query
    whole = np.vectorize(int, otypes=[object])
    return whole(cells) @ whole(query)


def search_group(queries: pd.DataFrame, blocks: pd.DataFrame, k: int = K) -> pd.DataFrame:
    """The candidates of each query in one group of blocks that can be among its k best."""
    width = max(int(queries["width"].max()), int(blocks["width"].max()))
    wide = lambda m: np.pad(np.asarray(m, float), ((0, 0), (0, width - m.shape[1])))
    cells = [wide(unpack(b)) for b in blocks.itertuples()]
    ids = [np.frombuffer(b, "<i8") for b in blocks["ids"]]
    rows = [np.frombuffer(b, "<i8") for b in blocks["rows"]]
    high, low = np.stack([c.max(axis=0) for c in cells]), np.stack([c.min(axis=0) for c in cells])
    out = []
    for q in queries.itertuples():
        vector = np.zeros(width)
        vector[: q.width] = np.frombuffer(q.cells, q.kind)
        bounds = exact_product(high, np.maximum(vector, 0)) + exact_product(low, np.minimum(vector, 0))
        order = np.argsort(-bounds, kind="stable")
        kth = -np.inf if q.kth is None or pd.isna(q.kth) else int(q.kth)
        best: list[tuple] = []
        for at in range(0, len(order), AT_ONCE):
            now = [b for b in order[at : at + AT_ONCE] if bounds[b] >= kth]
            if not now:
                break
            scores = np.concatenate([exact_product(cells[b], vector) for b in now])
            good = np.flatnonzero(scores >= kth)
            found_id, found_row = np.concatenate([ids[b] for b in now])[good], np.concatenate([rows[b] for b in now])[good]
            other = found_row != q.row
            found = zip((-scores[good][other]).tolist(), found_id[other].tolist(), found_row[other].tolist(), strict=True)
            best = sorted([*best, *((int(s), i, r) for s, i, r in found)])[:k]
            if len(best) == k:
                kth = max(kth, -best[-1][0])
        out.extend((q.query_id, q.row, i, r, str(-s)) for s, i, r in best)
    return pd.DataFrame(out, columns=["query_id", "row", "vec_id", "vec_row", "score"])


def search(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows for every row whose id ``every`` divides."""
    blocks = index(vectors, scale, block, group)
    queries, parts = query_rows(blocks, every)
    groups = (blocks.agg(F.max("grp").alias("g")).first()["g"] or 0) + 1
    top, done, most = None, 0, FIRST
    order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id", "vec_row")
    while done < groups:
        asked = queries.withColumn("kth", F.lit(None).cast("decimal(38,0)"))
        if top is not None:
            lowest = top.groupBy("row").agg(F.min(F.when(F.col("rank") == k, F.col("score"))).alias("kth"))
            asked = queries.join(lowest, "row", "left")
        now = blocks.where((F.col("grp") >= done) & (F.col("grp") < done + most))
        in_round = [g for g in range(done, min(done + most, groups))]
        each = asked.withColumn("grp", F.explode(F.sequence(F.lit(in_round[0]), F.lit(in_round[-1])).cast("array<long>")))
        held = now.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>")))
        found = each.groupBy("part", "grp").cogroup(held.groupBy("part", "grp")).applyInPandas(
            lambda q, b: search_group(q, b, k) if len(q) and len(b) else NOTHING,
            "query_id long, row long, vec_id long, vec_row long, score string",
        )
        found = found.withColumn("score", F.col("score").cast("decimal(38,0)"))
        if top is not None:
            found = found.unionByName(top.drop("rank"))
        top = stage(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "top")
        done, most = done + most, done + most
    bounded = F.greatest(F.least("score", F.lit((1 << 63) - 1)), F.lit(-(1 << 63)).cast("decimal(38,0)")).cast("long")
    return top.select("query_id", "rank", "vec_id", bounded.alias("score"))


NOTHING = pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("query_id", "int64"), ("row", "int64"), ("vec_id", "int64"), ("vec_row", "int64"), ("score", "str"))})
