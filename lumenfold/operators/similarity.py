"""Scaled feature vectors of entities, their cosines, most and least similar pairs."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.functions.stats import ZERO
from lumenfold.operators import cones
from lumenfold.operators.cones import BLOCK_ROWS, GROUP_BLOCKS, ConeTree
from lumenfold.plans import salted_join
from lumenfold.plans.stage import stage

# Similarities are ordered by this many places, then by the ids.
DIGITS = 9


def scale_features(panel: DataFrame, features: Sequence[str], entity: str = "entity", mode: str = "endpoint") -> DataFrame:
    """(entity, scaled features), for one row per entity.

    ``endpoint``: (v - first) / (last - first), with the values of the smallest and
    largest entity that has the feature; ``minmax``: with the least and greatest value. 0 where
    the divisor is 0. A missing value stays missing. The two ends per feature are one pre-combined aggregate, run here to one row of
    numbers, so that the scaled columns are plain arithmetic.
    """
    columns = [F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in features]
    numbers = panel.select(entity, *columns)
    if mode == "endpoint":
        # A null order takes no part, so each feature has ends of its own where it has gaps.
        at = {f: F.when(F.col(f).isNotNull(), F.struct(F.col(entity), F.col(f))) for f in features}
        ends = numbers.agg(
            F.struct(*[F.min_by(f, at[f]).alias(f) for f in features]).alias("low"),
            F.struct(*[F.max_by(f, at[f]).alias(f) for f in features]).alias("high"),
        )
    elif mode == "minmax":
        ends = numbers.agg(
            F.struct(*[F.min(f).alias(f) for f in features]).alias("low"),
            F.struct(*[F.max(f).alias(f) for f in features]).alias("high"),
        )
    else:
        raise ValueError("mode is 'endpoint' or 'minmax'")
    row = ends.first()

    def scaled(name: str) -> Column:
        low, high = row["low"][name], row["high"][name]
        if low is None or high is None:
            return F.lit(None).cast("double")
        if high == low:
            return F.when(F.col(name).isNotNull(), F.lit(0.0))
        return (F.col(name) - low) / (high - low)

    return numbers.select(entity, *[scaled(f).alias(f) for f in features])


def to_long(wide: DataFrame, features: Sequence[str], keys: Sequence[str] = ("entity",)) -> DataFrame:
    """(keys, feature, value) from one column per feature."""
    return wide.unpivot(list(keys), list(features), "feature", "value")


def to_vectors(long: DataFrame, key: str = "entity") -> DataFrame:
    """(key, vector) from (key, feature, value), values in feature order."""
    pairs = F.array_sort(F.collect_list(F.struct("feature", "value")))
    return long.groupBy(key).agg(F.transform(pairs, lambda p: p["value"]).alias("vector"))


def unit_vectors(wide: DataFrame, features: Sequence[str], entity: str = "entity", missing: str = "error") -> DataFrame:
    """(entity, vector) of length 1. An all-zero row has no direction and is left out.

    A row with a missing feature is an error when the vectors are read, or counts as zero
    there (``missing="zero"``), or is left out (``missing="drop"``).
    """
    if missing not in ("error", "zero", "drop"):
        raise ValueError("missing is 'error', 'zero' or 'drop'")
    whole = functools.reduce(lambda a, b: a & b, [F.col(f).isNotNull() & ~F.isnan(F.col(f)) for f in features])
    if missing == "zero":
        filled = [F.coalesce(F.nanvl(F.col(f), F.lit(None).cast("double")), F.lit(0.0)).alias(f) for f in features]
        wide = wide.select(entity, *filled)
    elif missing == "drop":
        wide = wide.where(whole)
    else:
        wide = wide.where(whole | F.raise_error("a feature is missing; say missing='zero' or missing='drop'").cast("boolean"))
    squares = [F.col(f) * F.col(f) for f in features]
    length = F.sqrt(functools.reduce(lambda a, b: a + b, squares))
    parts = wide.withColumn("_length", length).where("_length > 0 AND NOT isnan(_length)")
    return parts.select(F.col(entity).alias("entity"), F.array(*[F.col(f) / F.col("_length") for f in features]).alias("vector"))


def dot(a: Column, b: Column) -> Column:
    """Dot product of two arrays; of unit vectors, their cosine."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def pair_lookup(vectors: DataFrame, first, second) -> DataFrame:
    """(a, b, similarity) of one pair. Only the two rows are read from the vectors."""
    a = vectors.where(F.col("entity") == F.lit(first)).select(F.col("entity").alias("a"), F.col("vector").alias("va"))
    partner = vectors.where(F.col("entity") == F.lit(second)).select(F.struct("entity", "vector")).scalar()
    pair = a.limit(1).withColumn("_b", partner).where("_b IS NOT NULL")
    return pair.select("a", F.col("_b.entity").alias("b"), dot(F.col("va"), F.col("_b.vector")).alias("similarity"))


def entity_neighbours(vectors: DataFrame, queries: Sequence, k: int = 50) -> DataFrame:
    """(query, entity, similarity, rank): the ``k`` entities most similar to each query.

    ``queries`` is a list of entities; their vectors travel as one scalar, so the table is
    read without a join and each task forwards at most ``k`` rows per query. The entity
    itself takes part; similarities of 0 and below do not.
    """
    asked = vectors.where(F.col("entity").isin(list(queries)))
    q = asked.agg(F.collect_list(F.struct("entity", "vector"))).scalar()
    scored = vectors.select("entity", "vector", F.explode(q).alias("q")).select(
        F.col("q.entity").alias("query"), "entity", dot(F.col("vector"), F.col("q.vector")).alias("similarity")
    )
    near = F.round("similarity", DIGITS)
    order = Window.partitionBy("query").orderBy(near.desc(), "entity")
    ranked = scored.where(F.col("similarity") > ZERO).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k)


def all_entity_neighbours(
    vectors: DataFrame, k: int = 50, block_rows: int = BLOCK_ROWS, group_blocks: int = GROUP_BLOCKS
) -> DataFrame:
    """(query, entity, similarity, rank): the ``k`` entities most similar to every entity. Exact.

    The same rows as ``entity_neighbours`` with all entities as queries. A first round multiplies the blocks of each
    group of near directions, which gives every vector a k-th similarity to beat; the second round
    visits only the blocks whose cone can hold something better for some vector of a block.

    Equal vectors have equal lists, so the search runs once per distinct vector, among at most ``k`` of its copies.
    """
    order = Window.partitionBy("vector").orderBy("entity")
    copies = vectors.withColumn("_copy", F.row_number().over(order)).where(F.col("_copy") <= k)
    tree = cones.build_tree(copies.select("entity", (F.col("_copy") == 1).alias("first"), "vector"), block_rows, group_blocks)
    entity_type = vectors.schema["entity"].dataType.simpleString()
    schema = f"block long, query {entity_type}, entity {entity_type}, similarity double"

    inside = cones.block_pairs(tree, cones.every, of_groups=cones.same)
    near = stage(cones.work_on(tree, inside, _neighbour_work(k), schema), "near-neighbours")
    place = F.round("similarity", DIGITS)
    kth = F.when(F.count("*") >= k, F.min(place)).otherwise(ZERO).alias("kth")
    pairs = F.array_sort(F.collect_list(F.struct("query", "kth")))
    bars = near.groupBy("block", "query").agg(kth).groupBy("block").agg(F.min("kth").alias("bar"), pairs.alias("kths"))
    bars = stage(bars, "bars")

    def open_cones(ids_l, ids_r, between, reach, least):
        return cones.highest(between, reach) >= np.maximum(least, ZERO)[:, None]

    def open_blocks(ids_l, ids_r, between, reach, least):
        group = lambda ids: ids // cones.PART * cones.PART + ids % cones.PART // group_blocks
        return open_cones(ids_l, ids_r, between, reach, least) & (group(ids_l)[:, None] != group(ids_r)[None, :])

    rest = cones.block_pairs(cones.with_bars(tree, bars.select("block", "bar")), open_blocks, of_groups=open_cones)
    to_beat = bars.select(
        "block", F.transform("kths", lambda x: x["query"]).alias("kth_of"), F.transform("kths", lambda x: x["kth"]).alias("kth")
    )
    far = cones.work_on(tree, rest, _neighbour_work(k), schema, to_beat)
    best = Window.partitionBy("query").orderBy(place.desc(), "entity")
    ranked = near.unionAll(far).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    lists = ranked.groupBy("query").agg(F.collect_list(F.struct("entity", "similarity", "rank")).alias("list"))

    named = stage(vectors.groupBy("vector").agg(F.min("entity").alias("rep"), F.count("*").alias("rows")), "distinct-vectors")
    rows = vectors.select(F.col("entity").alias("query"), "vector")
    members = salted_join(rows, named.select("vector", "rep"), "vector", named.select("vector", "rows"), ["query"]).drop("vector")
    found = salted_join(members, lists.withColumnRenamed("query", "rep"), "rep", named.select("rep", "rows"), ["query"])
    return found.select("query", F.inline("list"))


def _neighbour_work(k: int) -> Callable[[dict, list], pd.DataFrame]:
    """Best neighbours of the first copies in the left blocks of some block pairs."""

    def work(held: dict, todo: list) -> pd.DataFrame:
        per_left: dict = {}
        for left, right in todo:
            per_left.setdefault(left, []).append(right)
        out = []
        for left, rights in per_left.items():
            row, ids, matrix = held[left]
            asked = np.flatnonzero(np.array(list(row.first)))
            if not len(asked):
                continue
            kths = dict(zip(row.kth_of, row.kth, strict=True)) if hasattr(row, "kth_of") and row.kth_of is not None else {}
            least = np.array([max(kths.get(q, ZERO), ZERO) for q in ids[asked]])
            best = None
            for right in rights:
                _, others, other = held[right]
                cosine = matrix[asked] @ other.T
                place = np.round(cosine, DIGITS)
                i, j = np.nonzero((place >= np.round(least, DIGITS)[:, None]) & (cosine > ZERO))
                new = pd.DataFrame({"at": i, "entity": others[j], "similarity": cosine[i, j], "place": place[i, j]})
                best = new if best is None else pd.concat([best, new])
                best = best.sort_values(["at", "place", "entity"], ascending=[True, False, True]).groupby("at").head(k)
                full = best.groupby("at")["place"].agg(["size", "min"])
                full = full[full["size"] == k]
                least[full.index.to_numpy(int)] = np.maximum(least[full.index.to_numpy(int)], full["min"].to_numpy())
            out.append(pd.DataFrame({"block": left, "query": ids[asked][best["at"].to_numpy(int)], "entity": best["entity"], "similarity": best["similarity"]}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame()

    return work


def extreme_pairs(vectors: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS, group_blocks: int = GROUP_BLOCKS) -> DataFrame:
    """(side, a, b, similarity): the ``k`` most and the ``k`` least similar pairs, a < b. Exact.

    Blocks of near directions are leaves of a tree of cones. A first round multiplies each block with itself, its nearest
    neighbour in its group, and the block that lies most opposite down the tree; it gives the similarity that the k-th
    best pair has at least (and the k-th worst at most). The second round walks down the tree once more
    and multiplies only the block pairs whose cones can still beat it.
    """
    tree = cones.build_tree(_k_per_vector(vectors, k).withColumn("first", F.lit(True)), block_rows, group_blocks)
    near = cones.block_pairs(tree, cones.itself_and_nearest, of_groups=cones.same)
    opposite = cones.block_pairs(tree, cones.farthest)
    seeds = stage(_best_of_blocks(tree, near.unionAll(opposite), k), "seeds")
    reach = seeds.groupBy("side").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    bar = {r["side"]: r["score"] for r in reach.collect() if r["n"] == k}
    top, bottom = bar.get("top", -math.inf), bar.get("bottom", -math.inf)

    def open_pairs(ids_l, ids_r, between, reach, _bars):
        better = (cones.highest(between, reach) >= top) | (-cones.lowest(between, reach) >= bottom)
        return better & (ids_r[None, :] >= ids_l[:, None])

    every = seeds
    if len(tree.blocks.select("block").take(2)) == 2:
        rest = _best_of_blocks(tree, cones.block_pairs(tree, open_pairs), k, bar)
        once = rest.unionAll(seeds).groupBy("side", "a", "b").agg(F.max("score").alias("score"))
        every = _k_best(once, k)
    sign = F.when(F.col("side") == "top", 1.0).otherwise(-1.0)
    return every.select("side", "a", "b", (F.col("score") * sign).alias("similarity"))


def _k_per_vector(vectors: DataFrame, k: int) -> DataFrame:
    """At most k + 1 entities of each distinct vector, the smallest ones.

    Any pair with a further copy ties with k pairs of smaller ids, so it cannot be among
    the k best. Each task forwards at most k + 1 rows of a vector, however many copies.
    """
    order = Window.partitionBy("vector").orderBy("entity")
    return vectors.withColumn("_copy", F.row_number().over(order)).where(F.col("_copy") <= k + 1).drop("_copy")


def _best_of_blocks(tree: ConeTree, pairs: DataFrame, k: int, bar: dict[str, float] | None = None) -> DataFrame:
    """The k best rows per side over the given block pairs, as (side, score, a, b).

    ``score`` is the rounded similarity, with its sign turned for the bottom side. Scores
    below ``bar`` may be left out.
    """
    entity_type = tree.blocks.schema["entities"].dataType.elementType.simpleString()
    digits, bars = DIGITS, dict(bar or {})

    def multiply(held: dict, todo: list) -> pd.DataFrame:
        margin = 10.0**-digits
        best = {"top": None, "bottom": None}

        def edge(side):
            least = bars.get(side, -np.inf)
            full = best[side] is not None and len(best[side]) == k
            return (max(least, best[side]["score"].min()) if full else least) - margin

        def collect(side, cosine, ids_l, ids_r):
            flat, limit = cosine.ravel(), edge(side)
            kept = np.flatnonzero(flat >= limit) if side == "top" else np.flatnonzero(flat <= -limit)
            score = flat[kept] if side == "top" else -flat[kept]
            if len(kept) > k:
                near = score >= np.partition(score, len(score) - k)[len(score) - k] - margin
                kept, score = kept[near], score[near]
            usable = score > -np.inf
            i, j = np.divmod(kept[usable], len(ids_r))
            a, b = ids_l[i], ids_r[j]
            place, a, b = np.round(score[usable], digits), np.where(a < b, a, b), np.where(a < b, b, a)
            first = np.lexsort((b, a, -place))[:k]  # of very many ties, too
            found = pd.DataFrame({"side": side, "score": place[first], "a": a[first], "b": b[first]})
            if len(found):
                merged = found if best[side] is None else pd.concat([best[side], found]).drop_duplicates(["a", "b"])
                best[side] = merged.sort_values(["score", "a", "b"], ascending=[False, True, True]).head(k)

        for left, right in sorted({(min(p), max(p)) for p in todo}):
            (_, ids_l, m_l), (_, ids_r, m_r) = held[left], held[right]
            for side, never in (("top", -np.inf), ("bottom", np.inf)):
                cosine = m_l @ m_r.T
                if left == right:
                    cosine[np.tril_indices(len(cosine))] = never
                collect(side, cosine, ids_l, ids_r)
        found = [f for f in best.values() if f is not None]
        return pd.concat(found) if found else pd.DataFrame()

    found = cones.work_on(tree, pairs, multiply, f"side string, score double, a {entity_type}, b {entity_type}")
    return _k_best(found.distinct(), k)


def _k_best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("side").orderBy(F.desc("score"), "a", "b")
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")
