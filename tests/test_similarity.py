import itertools
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.operators import cones, similarity as sm


def brute(vectors, k):
    pairs = []
    for (a, x), (b, y) in itertools.combinations(sorted(vectors.items()), 2):
        pairs.append((round(float(np.dot(x, y)), 9), a, b))
    top = sorted(pairs, key=lambda p: (-p[0], p[1], p[2]))[:k]
    bottom = sorted(pairs)[:k]
    return top, bottom


def frame(spark, vectors, kind="long"):
    rows = [(e, [float(v) for v in x]) for e, x in vectors.items()]
    return spark.createDataFrame(rows, f"entity {kind}, vector array<double>")


def unit(x):
    return x / np.linalg.norm(x)


def found(pairs):
    rows = [(r["side"], round(r["similarity"], 9), r["a"], r["b"]) for r in pairs.collect()]
    top = sorted(((s, a, b) for side, s, a, b in rows if side == "top"), key=lambda p: (-p[0], p[1], p[2]))
    return top, sorted((s, a, b) for side, s, a, b in rows if side == "bottom")


@pytest.mark.parametrize("block_rows,n", [(8, 150), (1000, 60), (5, 2), (5, 1)])
def test_extreme_pairs_equal_brute_force(spark, block_rows, n):
    rng = np.random.default_rng(n)
    vectors = {i: unit(rng.normal(size=5) + (2.0 if i % 3 else 0.0)) for i in range(n)}
    got = found(sm.extreme_pairs(frame(spark, vectors).repartition(3), 10, block_rows=block_rows))
    assert got == brute(vectors, 10)


def test_extreme_pairs_with_many_copies_and_text_ids(spark):
    rng = np.random.default_rng(1)
    copy = unit(rng.normal(size=4))
    vectors = {f"e{i:03}": copy if i % 3 == 0 else unit(rng.normal(size=4)) for i in range(120)}
    got = found(sm.extreme_pairs(frame(spark, vectors, "string"), 5, block_rows=10))
    assert got == brute(vectors, 5)


def test_no_vectors(spark):
    assert sm.extreme_pairs(frame(spark, {0: unit(np.ones(2))}).limit(0), 3).count() == 0


def bundles(rng, n, directions=2, size=3, spread=0.2):
    middles = [unit(rng.normal(size=size)) for _ in range(directions)]
    return {i: unit(middles[i % directions] + rng.normal(size=size) * spread) for i in range(n)}


def tree_of(spark, vectors, block_rows=8, group_blocks=4):
    rows = frame(spark, vectors).withColumn("first", F.lit(True))
    return cones.build_tree(rows, block_rows, group_blocks)


def pair_count(pairs):
    return sum(len(r["blocks_l"]) for r in pairs.collect())


def test_cones_hold_their_vectors_at_every_level(spark):
    vectors = bundles(np.random.default_rng(3), 300, 5, 4)
    tree = tree_of(spark, vectors)
    blocks = {r["block"]: r for r in tree.blocks.collect()}
    assert sorted(e for r in blocks.values() for e in r["entities"]) == list(range(300))
    assert max(len(r["entities"]) for r in blocks.values()) == 8
    for g in tree.groups.collect():
        for b in g["ids"]:
            inside = np.array([vectors[e] for e in blocks[b]["entities"]])
            assert blocks[b]["grp"] == g["grp"]
            assert cones.angles(inside, np.array([blocks[b]["centre"]])).max() <= blocks[b]["radius"] + 1e-9
            assert cones.angles(inside, np.array([g["centre"]])).max() <= g["radius"] + 1e-6


@pytest.mark.parametrize("n", [100, 700])
def test_blocks_and_groups_do_not_grow_with_the_rows(spark, n):
    tree = tree_of(spark, bundles(np.random.default_rng(4), n, 6), 8, 4)
    assert max(len(r["entities"]) for r in tree.blocks.select("entities").collect()) <= 8
    assert max(len(r["ids"]) for r in tree.groups.select("ids").collect()) <= 4


def test_bounds_close_pairs_of_far_blocks(spark):
    """Tight bundles: a search for near pairs walks past the groups of other bundles."""
    tree = tree_of(spark, bundles(np.random.default_rng(2), 400, 8, 4, 0.01))
    near = lambda a, b, between, reach, bars: (cones.highest(between, reach) >= 0.999) & (b[None, :] >= a[:, None])
    n = tree.blocks.count()
    assert pair_count(cones.block_pairs(tree, near)) < n * (n + 1) / 4
    assert pair_count(cones.block_pairs(tree, lambda a, b, *_: b[None, :] >= a[:, None])) == n * (n + 1) / 2


def brute_neighbours(vectors, k):
    out = {}
    for q, v in vectors.items():
        scored = sorted((-round(float(np.dot(v, w)), 9), e) for e, w in vectors.items() if np.dot(v, w) > 1e-12)
        out[q] = [(e, r) for r, (_, e) in enumerate(scored[:k], 1)]
    return out


def neighbour_lists(got):
    out = {}
    for r in sorted(got.collect(), key=lambda r: (r["query"], r["rank"])):
        out.setdefault(r["query"], []).append((r["entity"], r["rank"]))
    return out


@pytest.mark.parametrize("block_rows,group_blocks,n,k", [(8, 3, 200, 7), (1000, 32, 50, 60), (4, 2, 3, 2)])
def test_all_neighbours_equal_brute_force(spark, block_rows, group_blocks, n, k):
    vectors = bundles(np.random.default_rng(n), n, 6, 4, 0.5)
    got = sm.all_entity_neighbours(frame(spark, vectors).repartition(3), k, block_rows, group_blocks)
    assert neighbour_lists(got) == brute_neighbours(vectors, k)


def test_all_neighbours_with_many_copies_and_text_ids(spark):
    rng = np.random.default_rng(5)
    copy = unit(rng.normal(size=4))
    vectors = {f"e{i:03}": copy if i % 3 == 0 else unit(rng.normal(size=4)) for i in range(120)}
    got = sm.all_entity_neighbours(frame(spark, vectors, "string"), 6, 8, 2)
    assert neighbour_lists(got) == brute_neighbours(vectors, 6)
    assert sm.all_entity_neighbours(frame(spark, vectors, "string").limit(0), 6).count() == 0


PANEL = [(1, 5.0, 1.0, 2.0), (2, 9.0, 3.0, 2.0), (3, 1.0, 2.0, 2.0), (4, 7.0, 5.0, 2.0)]


def test_endpoint_scaling_uses_the_ends_of_the_entity_order(spark):
    df = spark.createDataFrame(PANEL, "entity long, x double, y double, flat double")
    got = {r["entity"]: (r["x"], r["y"], r["flat"]) for r in sm.scale_features(df, ["x", "y", "flat"]).collect()}
    assert got == {1: (0.0, 0.0, 0.0), 2: (2.0, 0.5, 0.0), 3: (-2.0, 0.25, 0.0), 4: (1.0, 1.0, 0.0)}
    low = {r["entity"]: r["x"] for r in sm.scale_features(df, ["x"], mode="minmax").collect()}
    assert low == {1: 0.5, 2: 1.0, 3: 0.0, 4: 0.75}


def test_vectors_neighbours_and_lookup(spark):
    df = spark.createDataFrame(PANEL, "entity long, x double, y double, flat double")
    scaled = sm.scale_features(df, ["x", "y"])
    vectors = sm.unit_vectors(scaled, ["x", "y"])
    assert sorted(r[0] for r in vectors.select("entity").collect()) == [2, 3, 4]
    v = {r["entity"]: np.array(r["vector"]) for r in vectors.collect()}
    assert all(np.linalg.norm(x) == pytest.approx(1) for x in v.values())
    near = sm.entity_neighbours(vectors, [2, 4], k=2).collect()
    assert [(r["query"], r["entity"], r["rank"]) for r in sorted(near)] == [(2, 2, 1), (2, 4, 2), (4, 2, 2), (4, 4, 1)]
    pair = sm.pair_lookup(vectors, 3, 4).collect()
    assert len(pair) == 1 and pair[0]["similarity"] == pytest.approx(v[3] @ v[4])
    assert sm.pair_lookup(vectors, 3, 77).collect() == []


def test_wide_to_long_to_vector(spark):
    df = spark.createDataFrame(PANEL, "entity long, x double, y double, flat double")
    long = sm.to_long(df, ["y", "x"])
    assert long.count() == 8
    got = {r["entity"]: r["vector"] for r in sm.to_vectors(long).collect()}
    assert got[3] == [1.0, 2.0]
    assert df.select(sm.dot(F.array("x", "y"), F.array("y", "flat"))).first()[0] == 7.0


def test_gaps_are_an_error_unless_an_option_says_otherwise(spark):
    rows = [(1, None, 2.0), (2, 1.0, 4.0), (3, 3.0, 8.0), (4, 5.0, None)]
    panel = spark.createDataFrame(rows, "entity long, x double, y double")
    scaled = sm.scale_features(panel, ["x", "y"])
    got = {r["entity"]: (r["x"], r["y"]) for r in scaled.collect()}
    assert got == {1: (None, 0.0), 2: (0.0, pytest.approx(1 / 3)), 3: (0.5, 1.0), 4: (1.0, None)}
    with pytest.raises(Exception, match="a feature is missing"):
        sm.unit_vectors(scaled, ["x", "y"]).collect()
    assert {r["entity"] for r in sm.unit_vectors(scaled, ["x", "y"], missing="drop").collect()} == {2, 3}
    zero = {r["entity"]: r["vector"] for r in sm.unit_vectors(scaled, ["x", "y"], missing="zero").collect()}
    assert set(zero) == {2, 3, 4} and zero[4] == [1.0, 0.0]


def test_nearest_pivots_take_memory_by_portions():
    rng = np.random.default_rng(5)
    vectors, pivots = rng.normal(size=(10_000, 6)), rng.normal(size=(1024, 6))
    tracemalloc.start()
    ranks, angle = cones.nearest_pivots(vectors, pivots)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    cosines = vectors @ pivots.T
    assert (ranks[:, 0] == cosines.argmax(axis=1)).all()
    assert angle == pytest.approx(np.arccos(np.clip(cosines.max(axis=1), -1, 1)))
    assert peak < 40e6
