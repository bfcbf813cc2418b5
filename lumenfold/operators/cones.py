"""A tree of direction cones over unit vectors, for exact searches that skip far parts of it.

Vectors are ordered by their nearest pivots and cut into *blocks* of ``block_rows``; neighbouring blocks make a
*group*, neighbouring groups a *tile*. Each has a cone: a centre and an angle that holds all its vectors.
With the angle between two centres, the two radii bound every cosine between two cones. A search
walks from pairs of tiles to pairs of groups to pairs of blocks, keeps those whose bound it needs,
and brings the matrices of two groups together once for all their surviving block pairs.

All sizes are fixed, whatever the number of rows: a task holds two groups. Only the tiles come to the
driver, one per ``block_rows * group_blocks * TILE_PARTS`` vectors (33 million by default).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.plans.stage import stage

PIVOTS = 1024
NEAREST_PIVOTS = 3
VECTORS_AT_ONCE = 512
BLOCK_ROWS = 1024
GROUP_BLOCKS = 32
TILE_PARTS = 1024
# Rounding of angles and cosines never closes a pair.
SLACK = 1e-6
# Numbers of blocks and groups within a part of the range sort.
PART = 1 << 20

# (left ids, right ids, angles between centres, sums of radii, bars of the left side) -> which pairs to keep.
Choice = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
CONES = "ids array<long>, centres binary, radii binary"


@dataclass
class ConeTree:
    """blocks: block, grp, entities, first, matrix, width; groups: grp, tile and the cones of their blocks; tiles: likewise."""

    blocks: DataFrame
    groups: DataFrame
    tiles: DataFrame


def cone(directions: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, float]:
    """The centre and radius of a cone that holds the given cones."""
    centre = directions.mean(axis=0)
    length = np.linalg.norm(centre)
    centre = centre / length if length > 1e-9 else directions[0]
    return centre, float(min(math.pi, (angles(directions, centre[None])[:, 0] + radii).max()))


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivots of every vector, and the angle to the first; some vectors at a time."""
    ranks, angle = [], []
    for at in range(0, len(vectors), VECTORS_AT_ONCE):
        cosines = vectors[at : at + VECTORS_AT_ONCE] @ pivots.T
        ranks.append(np.argsort(-cosines, axis=1, kind="stable")[:, :NEAREST_PIVOTS].copy())
        angle.append(np.arccos(np.clip(cosines.max(axis=1), -1, 1)))
    return np.concatenate(ranks), np.concatenate(angle)


def build_tree(vectors: DataFrame, block_rows: int = BLOCK_ROWS, group_blocks: int = GROUP_BLOCKS) -> ConeTree:
    """The tree over (entity, first, vector). ``first`` is carried along."""
    staged = stage(vectors.select("entity", "first", "vector"), "vectors")
    rows = staged.count()
    parts = max(1, math.ceil(rows / (block_rows * group_blocks)))
    wanted = min(PIVOTS, max(1, math.ceil(rows / block_rows)))
    picked = staged.orderBy(F.xxhash64("entity"), "entity").limit(wanted).collect()
    pivots = np.array([r["vector"] for r in picked])
    entity_type = staged.schema["entity"].dataType.simpleString()
    order = [f"near{n}" for n in range(NEAREST_PIVOTS)]

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                ranks, angle = nearest_pivots(np.stack(batch["vector"].to_list()), pivots)
                near = {c: ranks[:, min(n, ranks.shape[1] - 1)] for n, c in enumerate(order)}
                yield batch.assign(**near, angle=angle)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0

        def block(frame: pd.DataFrame) -> pd.DataFrame:
            m = np.stack(frame["vector"].to_list())
            centre, radius = cone(m, np.zeros(len(m)))
            grp = part * PART + count // group_blocks
            row = (part * PART + count, grp, part // TILE_PARTS, frame["entity"].to_list(), frame["first"].to_list(), m.tobytes(), centre, radius)
            return pd.DataFrame([row], columns=["block", "grp", "tile", "entities", "first", "matrix", "centre", "radius"])

        def cut(near: np.ndarray) -> int:
            """Rows of the next block: up to the last change of the nearest pivot in its second half, if there is one."""
            changes = np.flatnonzero(near[block_rows // 2 : block_rows] != near[block_rows // 2 + 1 : block_rows + 1])
            return block_rows // 2 + 1 + int(changes[-1]) if len(changes) else block_rows

        waiting: list[pd.DataFrame] = []
        for batch in batches:
            waiting.append(batch)
            if sum(map(len, waiting)) > block_rows:
                frame = pd.concat(waiting, ignore_index=True)
                while len(frame) > block_rows:
                    n = cut(frame["near0"].to_numpy())
                    yield block(frame.iloc[:n])
                    count += 1
                    frame = frame.iloc[n:]
                waiting = [frame]
        if sum(map(len, waiting)):
            yield block(pd.concat(waiting, ignore_index=True))

    near_type = ", ".join(f"{c} long" for c in order)
    placed = staged.mapInPandas(nearest, f"entity {entity_type}, first boolean, vector array<double>, {near_type}, angle double")
    keys = [*order, "angle", "entity"]
    ordered = placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    blocks = ordered.select("entity", "first", "vector", "near0").mapInPandas(
        build,
        f"block long, grp long, tile long, entities array<{entity_type}>, first array<boolean>, matrix binary, centre array<double>, radius double",
    )
    blocks = stage(blocks, "cone-blocks")
    groups = stage(parents(blocks.select("block", "grp", "tile", "centre", "radius"), "block", "grp", ["tile"]), "cone-groups")
    tiles = stage(parents(groups, "grp", "tile", []), "cone-tiles")
    return ConeTree(blocks, groups, tiles)


def parents(children: DataFrame, child: str, parent: str, carry: list[str]) -> DataFrame:
    """(parent, carried columns, centre, radius, ids, centres, radii) with the cones of the children in the order of their ids."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(child)
        directions, radii = np.stack(frame["centre"].to_list()), frame["radius"].to_numpy()
        centre, radius = cone(directions, radii)
        row = [frame[parent].iloc[0], *(frame[c].iloc[0] for c in carry), centre, radius]
        row += [frame[child].tolist(), directions.tobytes(), radii.tobytes()]
        return pd.DataFrame([row], columns=[parent, *carry, "centre", "radius", "ids", "centres", "radii"])

    carried = "".join(f"{c} long, " for c in carry)
    schema = f"{parent} long, {carried}centre array<double>, radius double, {CONES}"
    return children.select(child, parent, *carry, "centre", "radius").groupBy(parent).applyInPandas(merge, schema)


def with_bars(tree: ConeTree, bars: DataFrame) -> ConeTree:
    """The tree with the bar of every block, from (block, bar), and their least ones further up, as ``bars`` of the members."""

    def put(frames: DataFrame, child: str, parent: str, of_child: DataFrame) -> tuple[DataFrame, DataFrame]:
        places = frames.select(parent, F.posexplode("ids").alias("at", child)).join(of_child, child, "left")
        bar = F.coalesce("bar", F.lit(-math.inf))
        listed = places.groupBy(parent).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("at", bar.alias("bar")))), lambda x: x["bar"]).alias("bars"),
            F.min(bar).alias("bar"),
        )
        return stage(frames.join(listed.drop("bar"), parent), f"{parent}-bars"), listed.select(parent, "bar")

    groups, of_groups = put(tree.groups, "block", "grp", bars)
    tiles, of_tiles = put(tree.tiles, "grp", "tile", of_groups)
    return ConeTree(tree.blocks, groups, tiles.join(of_tiles, "tile"))


def _cones(row, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, radii = np.asarray(getattr(row, f"{side}_ids")), np.frombuffer(getattr(row, f"{side}_radii"))
    return ids, np.frombuffer(getattr(row, f"{side}_centres")).reshape(len(ids), -1), radii


def _below(pairs: DataFrame, nodes: DataFrame, parent: str, choose: Choice, lists: bool) -> DataFrame:
    """Pairs of children that ``choose`` keeps, for pairs (left, right) of parents."""
    sided = [
        nodes.select(F.col(parent).alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("ids", "centres", "radii", "bars") if c in nodes.columns])
        for side in ("left", "right")
    ]
    loaded = pairs.join(sided[0], "left").join(sided[1].drop("right_bars"), "right")

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                (ids_l, centres_l, radii_l), (ids_r, centres_r, radii_r) = _cones(row, "left"), _cones(row, "right")
                bars = np.asarray(getattr(row, "left_bars", np.full(len(ids_l), -math.inf)), float)
                kept = choose(ids_l, ids_r, angles(centres_l, centres_r), radii_l[:, None] + radii_r[None, :], bars)
                at = np.nonzero(kept)
                if not len(at[0]):
                    continue
                if lists:
                    yield pd.DataFrame([(row.left, row.right, ids_l[at[0]], ids_r[at[1]])], columns=["grp_l", "grp_r", "blocks_l", "blocks_r"])
                else:
                    yield pd.DataFrame({"left": ids_l[at[0]], "right": ids_r[at[1]]})

    schema = "grp_l long, grp_r long, blocks_l array<long>, blocks_r array<long>" if lists else "left long, right long"
    return loaded.mapInPandas(pick, schema)


def block_pairs(tree: ConeTree, choose: Choice, of_groups: Choice | None = None) -> DataFrame:
    """(grp_l, grp_r, blocks_l, blocks_r): the block pairs that are kept, one row per pair of groups.

    ``choose`` is asked for pairs of tiles, then of groups, then of blocks; ``of_groups`` in its place on the first two.
    """
    upper = of_groups or choose
    table = tree.tiles.drop("ids", "centres", "radii").orderBy("tile").toPandas()
    ids, radii = table["tile"].to_numpy(), table["radius"].to_numpy()
    centres = np.stack(table["centre"].to_list()) if len(table) else np.zeros((0, 1))
    bars = table["bar"].to_numpy() if "bar" in table else np.full(len(ids), -math.inf)
    kept = np.argwhere(upper(ids, ids, angles(centres, centres), radii[:, None] + radii[None, :], bars)) if len(ids) else []
    rows = [(int(ids[a]), int(ids[b])) for a, b in kept]
    pairs = tree.blocks.sparkSession.createDataFrame(rows, "left long, right long")
    of_tiles = _below(pairs, tree.tiles, "tile", upper, lists=False)
    return _below(of_tiles, tree.groups, "grp", choose, lists=True)


def same(ids_l, ids_r, _angles, _reach, _bars) -> np.ndarray:
    return ids_l[:, None] == ids_r[None, :]


def every(ids_l, ids_r, _angles, _reach, _bars) -> np.ndarray:
    return np.ones((len(ids_l), len(ids_r)), bool)


def farthest(ids_l, ids_r, between, _reach, _bars) -> np.ndarray:
    kept = np.zeros((len(ids_l), len(ids_r)), bool)
    kept[np.arange(len(ids_l)), between.argmax(axis=1)] = True
    return kept


def itself_and_nearest(ids_l, ids_r, between, _reach, _bars) -> np.ndarray:
    alone = ids_l[:, None] == ids_r[None, :]
    away = np.where(alone, math.inf, between)
    nearest = np.zeros_like(alone)
    nearest[np.arange(len(ids_l)), away.argmin(axis=1)] = True
    return alone | (nearest & ~alone)


def highest(between: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """The largest cosine two cones can hold between them."""
    return np.cos(np.maximum(between - reach - SLACK, 0)) + SLACK


def lowest(between: np.ndarray, reach: np.ndarray) -> np.ndarray:
    return np.cos(np.minimum(between + reach + SLACK, math.pi)) - SLACK


def work_on(tree: ConeTree, pairs: DataFrame, work: Callable[[dict, list], pd.DataFrame], schema: str, extra: DataFrame | None = None) -> DataFrame:
    """Apply ``work`` to every row of ``pairs``: (blocks by number, list of block pairs) -> rows.

    Each block of the two groups is sent once per pair of groups. ``extra`` adds columns by block.
    """
    pairs = stage(pairs, "block-pairs")
    both = F.array_distinct(F.concat("blocks_l", "blocks_r"))
    blocks = tree.blocks.select("block", "entities", "first", "matrix")
    blocks = blocks if extra is None else blocks.join(extra, "block", "left")
    sent = pairs.select("grp_l", "grp_r", F.explode(both).alias("block")).join(blocks, "block")
    listed = pairs.select("grp_l", "grp_r", "blocks_l", "blocks_r")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        is_list = frame["blocks_l"].notna()
        todo = [p for r in frame[is_list].itertuples() for p in zip(r.blocks_l, r.blocks_r, strict=True)]
        held = {}
        for r in frame[~is_list].itertuples(index=False):
            ids = np.array(list(r.entities))
            held[r.block] = r, ids, np.frombuffer(r.matrix).reshape(len(ids), -1)
        return work(held, todo)

    rows = sent.unionByName(listed, allowMissingColumns=True)
    return rows.groupBy("grp_l", "grp_r").applyInPandas(run, schema)
