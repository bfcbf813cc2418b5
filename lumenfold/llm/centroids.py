"""Centroid clustering over a persisted matrix of exact dot products.

Every component x of a vector becomes the integer floor(64 * x). For each vector the dot products with all
centroids are kept in a written table, next to its packed components. When centroids move, a dot
product changes by the inner product of the vector with the change of the centroid, and only the nonzero
components of that change are multiplied. A distance is |x|^2 - 2 x.c + |c|^2, so the nearest centroid is
the least of |c|^2 - 2 x.c; the distance itself needs |x|^2 as well. All numbers are integers: doubles
serve as long as they hold every sum exactly, whole numbers of any size otherwise.

A task sends one partial sum per cluster and dimension. The driver sees those sums for
``CLUSTERS`` centroids and nothing that grows with the rows; no vector is shuffled. Each round
reads one written table and writes the next, so a lost executor costs the tasks it ran.

Kept are vectors with exactly ``WIDTH`` components, none null or non-finite. With fewer kept vectors than clusters,
each is a centroid; none gives an empty result. Repeated rows and equal ids are vectors of their own; equal
hashes go by components. A null id is hashed as an empty one. Extra columns are ignored. Distances and sums beyond
the range of long are cut to its end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.plans.stage import stage

SCALE = 64
WIDTH = 64
CLUSTERS = 16
ROUNDS = 3
SEED = "1"
EXACT = float(1 << 53)
LONG = (1 << 63) - 1
# Sums travel as two numbers, low * 1 + high * 2^LIMB, which decimals hold for any finite component.
LIMB = 48
STATE = "vec_id long, kind string, cells binary, dot_kind string, dots binary, cluster int, distance long"


def whole(numbers: np.ndarray) -> np.ndarray:
    return np.vectorize(int, otypes=[object])(numbers) if np.size(numbers) else np.zeros(np.shape(numbers), object)


def product(cells: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``cells`` with ``vector``, a list of whole numbers."""
    top = max((abs(int(v)) for v in vector), default=0)
    if float(np.abs(cells).max(initial=0)) * float(top) * max(len(vector), 1) < EXACT:
        return (cells @ vector.astype(float)).astype(np.int64)
    return whole(cells) @ vector


def pack_cells(cells: np.ndarray) -> tuple[str, np.ndarray]:
    """The smallest type that holds the cells, and the cells in it."""
    top = np.abs(cells).max(initial=0)
    kind = "i1" if top < 1 << 7 else "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8"
    return kind, cells.astype(kind)


def unpack_cells(batch: pa.RecordBatch, width: int) -> np.ndarray:
    kinds = np.array(batch.column("kind").to_pylist(), dtype=object)
    packed = batch.column("cells").to_pylist()
    cells = np.zeros((len(packed), width))
    for kind in set(kinds):
        at = np.flatnonzero(kinds == kind)
        cells[at] = np.frombuffer(b"".join(packed[i] for i in at), kind).reshape(-1, width)
    return cells


def pack_dots(dots: np.ndarray) -> tuple[str, list[bytes]]:
    top = max(abs(int(dots.max(initial=0))), abs(int(dots.min(initial=0))))
    if top > LONG:
        return "text", [",".join(map(str, row)).encode() for row in dots]
    kind = "<i4" if top < 1 << 31 else "<i8"
    return kind, [row.tobytes() for row in dots.astype(kind)]


def unpack_dots(batch: pa.RecordBatch, clusters: int) -> np.ndarray:
    kinds = np.array(batch.column("dot_kind").to_pylist(), dtype=object)
    packed = batch.column("dots").to_pylist()
    dots = np.zeros((len(packed), clusters), object if "text" in kinds else np.int64)
    for kind in set(kinds):
        at = np.flatnonzero(kinds == kind)
        if kind == "text":
            dots[at] = [[int(n) for n in packed[i].split(b",")] for i in at]
        else:
            dots[at] = np.frombuffer(b"".join(packed[i] for i in at), kind).reshape(-1, clusters)
    return dots


def assigned(cells: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The nearest centroid of each row, the first of equals, and the squared distance."""
    own = [sum(int(v) ** 2 for v in c) for c in centroids]
    big = dots.dtype == object or max(own) >= LONG // 4 or int(np.abs(dots).max(initial=0)) >= LONG // 8
    parts = np.array(own, object if big else np.int64) - 2 * (dots.astype(object) if big else dots)
    nearest = np.argmin(parts, axis=1).astype(np.int32) if len(parts) else np.zeros(0, np.int32)
    top = float(np.abs(cells).max(initial=0))
    squares = (cells * cells).sum(axis=1).astype(np.int64) if top * top * cells.shape[1] < EXACT else (whole(cells) ** 2).sum(axis=1)
    best = parts[np.arange(len(parts)), nearest]
    return nearest, [min(int(s) + int(b), LONG) for s, b in zip(squares, best, strict=True)]


def state_batch(ids: pa.Array, cells: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    nearest, distance = assigned(cells, dots, centroids)
    kind, small = pack_cells(cells)
    dot_kind, packed = pack_dots(dots)
    columns = [
        ids,
        pa.array([kind] * len(ids), pa.string()),
        pa.array([row.tobytes() for row in small], pa.binary()),
        pa.array([dot_kind] * len(ids), pa.string()),
        pa.array(packed, pa.binary()),
        pa.array(nearest, pa.int32()),
        pa.array(distance, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["vec_id", "kind", "cells", "dot_kind", "dots", "cluster", "distance"])


def rows_of(batch: pa.RecordBatch, scale: int, width: int) -> np.ndarray:
    values = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * values.astype(float)).reshape(-1, width)


def kept_vectors(vectors: DataFrame, width: int = WIDTH) -> DataFrame:
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return plain.where((F.size("embedding") == width) & ~bad)


def first_centroids(kept: DataFrame, clusters: int, scale: int, seed: str) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id. Only ``clusters`` rows come to the driver."""
    name = F.sha2(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = kept.select(name.alias("name"), "embedding").orderBy("name", "embedding").limit(clusters).collect()
    return whole(np.floor(scale * np.array([r["embedding"] for r in chosen], float))) if chosen else np.zeros((0, 0), object)


def first_state(kept: DataFrame, centroids: np.ndarray, scale: int, width: int) -> DataFrame:
    """Every vector with its dot products with all centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = rows_of(batch, scale, width)
            columns = [product(cells, c) for c in centroids]
            yield state_batch(batch.column("vec_id"), cells, np.stack(columns, axis=1), centroids)

    return kept.mapInArrow(run, STATE)


def moved_state(state: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """The state after the centroids have moved: products with the nonzero changes are added."""
    changes = after - before
    places = [np.flatnonzero(row) for row in changes != 0]
    clusters, width = after.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, dots = unpack_cells(batch, width), unpack_dots(batch, clusters)
            columns = [dots[:, j] for j in range(clusters)]
            for j, at in enumerate(places):
                if len(at):
                    columns[j] = columns[j].astype(object) + product(cells[:, at], changes[j][at])
            big = any(abs(int(n)) > LONG for c in columns for n in (c.max(initial=0), c.min(initial=0)))
            dots = np.stack([c.astype(object if big else np.int64) for c in columns], axis=1)
            yield state_batch(batch.column("vec_id"), cells, dots, after)

    return state.mapInArrow(run, STATE)


def cluster_sums(state: DataFrame, clusters: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums (clusters x width) and counts of the vectors of each cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, of = unpack_cells(batch, width), batch.column("cluster").to_numpy()
            safe = float(np.abs(cells).max(initial=0)) * max(len(cells), 1) < EXACT
            rows = []
            for c in np.unique(of):
                mine = cells[of == c]
                sums = mine.sum(axis=0).astype(np.int64) if safe else whole(mine).sum(axis=0)
                numbers = [(d, int(s)) for d, s in enumerate(sums)] + [(-1, len(mine))]
                rows += [(int(c), d, Decimal(n >> LIMB), Decimal(n & ((1 << LIMB) - 1))) for d, n in numbers]
            kinds = [pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.decimal128(38, 0)]
            names = ["cluster", "dim", "high", "low"]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    parts = state.select("kind", "cells", "cluster").mapInArrow(run, "cluster int, dim int, high decimal(38,0), low decimal(38,0)")
    totals = parts.groupBy("cluster", "dim").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    sums, counts = np.zeros((clusters, width), object), np.zeros(clusters, object)
    for r in totals:
        n = (int(r["high"]) << LIMB) + int(r["low"])
        if r["dim"] < 0:
            counts[r["cluster"]] = n
        else:
            sums[r["cluster"], r["dim"]] = n
    return sums, counts


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, width: int = WIDTH, seed: str = SEED
) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    kept = kept_vectors(vectors, width)
    centroids = first_centroids(kept, clusters, scale, seed)
    if not len(centroids):
        nothing = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], nothing)
    state = stage(first_state(kept, centroids, scale, width), "dot-products")
    for _ in range(rounds):
        sums, counts = cluster_sums(state, len(centroids), width)
        after = np.array([s // n if n else c for s, n, c in zip(sums, counts, centroids, strict=True)], object)
        if (after != centroids).any():
            state = stage(moved_state(state, centroids, after), "dot-products")
        centroids = after
    totals = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()
    per_cluster = {r["cluster"]: int(r["n"]) for r in totals}
    all_of_them = min(sum(per_cluster.values()), LONG)
    rows = [
        (c, min(per_cluster.get(c, 0), LONG), all_of_them, hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for c, centroid in enumerate(centroids)
    ]
    names = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = state.select("vec_id", "cluster", "distance").join(F.broadcast(names), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
