import numpy as np
import pytest

from lumenfold.operators import recommend


def test_last_rating_by_order(spark):
    events = spark.createDataFrame(
        [("u", "i", 1.0, 1), ("u", "i", 5.0, 3), ("u", "i", 2.0, 2), ("v", "i", 4.0, 1)],
        "user string, item string, rating double, moment long",
    )
    got = recommend.last_ratings(events.repartition(3), ["moment", "rating"]).collect()
    assert sorted(tuple(r) for r in got) == [("u", "i", 5.0), ("v", "i", 4.0)]


def test_support_filter_is_one_pass_each(spark, hot_pieces):
    rows = [(f"u{u}", "a") for u in range(4)] + [(f"u{u}", "b") for u in range(3)] + [("u9", "c"), ("u0", "c")]
    ratings = spark.createDataFrame([(u, i, 1.0) for u, i in rows], "user string, item string, rating double")
    got = recommend.support_filter(ratings, min_users=3, min_items=2)
    # c falls first; u3 keeps only a and falls; a is not counted again afterwards.
    assert sorted((r["user"], r["item"]) for r in got.collect()) == [(f"u{u}", i) for u in range(3) for i in "ab"]


def model(matrix, target, k):
    """The same by numpy on a dense matrix with NaN for no rating."""
    have = ~np.isnan(matrix)
    centred = np.where(have, matrix - np.nanmean(matrix, axis=0), 0.0)
    norms = np.sqrt((centred**2).sum(axis=0))
    scores = {}
    for item in range(matrix.shape[1]):
        both = have[:, target] & have[:, item]
        if both.sum() >= 2 and norms[target] * norms[item] > 0:
            s = (centred[both, target] * centred[both, item]).sum() / (norms[target] * norms[item])
            if s > 1e-12:
                scores[item] = s
    best = sorted(scores, key=lambda i: (-round(scores[i], 9), i))[:k]
    predicted = {}
    for user in range(matrix.shape[0]):
        rated = [i for i in best if have[user, i]]
        if len(rated) >= 2:
            weighted = sum(scores[i] * matrix[user, i] for i in rated) / sum(scores[i] for i in rated)
            value = matrix[user, target] if have[user, target] else weighted
            if value > 0:
                predicted[user] = value
    return {i: scores[i] for i in best}, predicted


@pytest.mark.parametrize("partitions", [1, 6])
def test_neighbours_and_predictions(spark, hot_pieces, partitions):
    rng = np.random.default_rng(7)
    matrix = np.where(rng.random((40, 12)) < 0.4, rng.integers(1, 6, (40, 12)).astype(float), np.nan)
    matrix[0, :] = rng.integers(1, 6, 12)  # one user with every item
    matrix[:, 11] = np.where(np.isnan(matrix[:, 11]), np.nan, 3.0)  # an item of one rating value
    data = [(u, i, float(matrix[u, i])) for u in range(40) for i in range(12) if not np.isnan(matrix[u, i])]
    ratings = spark.createDataFrame(data, "user long, item long, rating double").repartition(partitions).cache()
    targets = spark.createDataFrame([(0,), (3,), (11,), (99,)], "item long")
    near = recommend.item_neighbours(ratings, targets, k=4).cache()
    predicted = recommend.predict_ratings(ratings, near).collect()
    for target in (0, 3, 11):
        scores, values = model(matrix, target, 4)
        rows = {r["item"]: r["similarity"] for r in near.collect() if r["target"] == target}
        assert rows == pytest.approx(scores)
        assert {r["user"]: r["rating"] for r in predicted if r["target"] == target} == pytest.approx(values)
        known = {r["user"] for r in predicted if r["target"] == target and r["known"]}
        assert known == {u for u in values if not np.isnan(matrix[u, target])}
    assert not [r for r in near.collect() if r["target"] == 99]
    others = recommend.item_neighbours(ratings, targets, k=4, include_self=False)
    assert not [r for r in others.collect() if r["target"] == r["item"]]


def neighbour_lists(rows):
    out = {}
    for r in sorted(rows.collect(), key=lambda r: (r["target"], r["rank"])):
        out.setdefault(r["target"], []).append((r["item"], pytest.approx(r["similarity"])))
    return out


@pytest.mark.parametrize("item_block,unit_ratings,partitions", [(3, 20, 6), (5, 10_000, 1), (100, 7, 2)])
def test_neighbours_of_all_items(spark, hot_pieces, item_block, unit_ratings, partitions):
    rng = np.random.default_rng(11)
    matrix = np.where(rng.random((60, 20)) < 0.3, rng.integers(1, 6, (60, 20)).astype(float), np.nan)
    matrix[0, :] = rng.integers(1, 6, 20)  # a user with every item
    matrix[:, 4] = np.where(np.isnan(matrix[:, 4]), rng.integers(1, 6, 60), matrix[:, 4])  # an item of every user
    matrix[:, 19] = np.where(np.isnan(matrix[:, 19]), np.nan, 3.0)  # an item of one rating value
    data = [(u, i, float(matrix[u, i])) for u in range(60) for i in range(20) if not np.isnan(matrix[u, i])]
    ratings = spark.createDataFrame(data, "user long, item long, rating double").repartition(partitions).cache()
    got = neighbour_lists(recommend.all_item_neighbours(ratings, 4, item_block=item_block, unit_ratings=unit_ratings))
    for target in range(20):
        scores, _ = model(matrix, target, 4)
        assert got.get(target, []) == list(scores.items())
    others = recommend.all_item_neighbours(ratings, 4, include_self=False, item_block=item_block, unit_ratings=unit_ratings)
    wanted = recommend.item_neighbours(ratings, ratings.select("item").distinct(), 4, include_self=False)
    assert neighbour_lists(others) == neighbour_lists(wanted)


def test_a_user_with_every_item_is_split_and_far_blocks_are_left_out(spark, monkeypatch):
    """Items of users that never meet have no block pair; pieces of the greedy user are block by block."""
    rows = [(u, i, float((u * 7 + i * 3) % 5 + 1)) for u in range(40) for i in range(24) if (u < 20) == (i < 12)]
    rows += [(99, i, float(i % 5 + 1)) for i in range(24)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double").cache()
    sizes, products = [], recommend._block_products

    def watched(placed, unit):
        counts = placed.groupBy("a", "b", "user").count().collect()
        sizes.extend(r["count"] for r in counts)
        return products(placed, unit)

    monkeypatch.setattr(recommend, "_block_products", watched)
    got = neighbour_lists(recommend.all_item_neighbours(ratings, 3, item_block=4))
    wanted = neighbour_lists(recommend.item_neighbours(ratings, ratings.select("item").distinct(), 3))
    assert got == wanted and max(sizes) < 24


def test_all_items_of_no_ratings(spark):
    assert recommend.all_item_neighbours(spark.createDataFrame([], "user long, item long, rating double")).count() == 0


def test_a_block_pair_sends_each_rating_once_per_block(spark, monkeypatch):
    """A rating goes to a few block pairs in a few bytes; only the best pairs of items leave."""
    rng = np.random.default_rng(2)
    rows = {(int(u), int(i)) for u, i in zip(rng.integers(0, 2_000, 60_000), rng.integers(0, 4_000, 60_000))}
    rows = [(u, i, float(v)) for (u, i), v in zip(sorted(rows), rng.integers(1, 51, len(rows)))]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double").coalesce(1).cache()
    packed, best = [], recommend._block_products

    def watched(placed, limits):
        packed.append(placed.where("user IS NOT NULL").count())
        found = best(placed, limits).cache()
        packed.append(found.count())
        return found

    monkeypatch.setattr(recommend, "_block_products", watched)
    got = recommend.all_item_neighbours(ratings, 5).cache()
    assert got.groupBy("target").count().where("count > 5").isEmpty()
    assert packed[0] <= recommend.LEAST_BLOCKS * len(rows)
    assert packed[1] <= 2 * 5 * recommend.LEAST_BLOCKS * 4_000
    some = spark.createDataFrame([(7,), (1_234,), (3_999,)], "item long")
    wanted = neighbour_lists(recommend.item_neighbours(ratings, some, 5))
    assert {t: v for t, v in neighbour_lists(got.join(some.withColumnRenamed("item", "target"), "target")).items()} == wanted


def test_ratings_without_user_or_item_meet_no_others(spark):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(1, 9) for i in range(1, 5)] + [(None, 1, 5.0), (None, 2, 5.0), (None, 3, 1.0), (3, None, 2.0), (4, None, 4.0)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double").cache()
    whole = ratings.where("user IS NOT NULL AND item IS NOT NULL")
    assert neighbour_lists(recommend.all_item_neighbours(ratings, 3)) == neighbour_lists(recommend.all_item_neighbours(whole, 3))


def test_a_rating_is_packed_once_and_the_packed_ratings_are_shared(spark, monkeypatch):
    """Half of the blocks go to a task as the ratings of a table grow, and no rating is packed for each of them."""
    rng = np.random.default_rng(4)
    rows = sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, 900, 18_000), rng.integers(0, 600, 18_000))})
    rows = [(u, i, float(v)) for (u, i), v in zip(rows, rng.integers(1, 51, len(rows)))]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double").coalesce(1).cache()
    placed, products = [], recommend._block_products

    def watched(some, limits):
        placed.append(some.where("user IS NOT NULL").count())
        return products(some, limits)

    monkeypatch.setattr(recommend, "_block_products", watched)
    got = neighbour_lists(recommend.all_item_neighbours(ratings, 5, item_block=25))
    assert placed == [len(rows)]
    assert got == neighbour_lists(recommend.all_item_neighbours(ratings, 5, item_block=600))
    routes = recommend._routes({b: 10 for b in range(36)}, 20)
    pairs = [(a, b) for b, ways in routes.items() for a, _, slices, turn in ways if slices == 1 and turn in (-1, b)]
    assert {(a, b) for a in range(36) for b in range(a, 36)} == set(pairs) and len(pairs) < 36 * 36 * 0.62


def test_slices_of_a_span_are_powers_of_two():
    routes = recommend._routes({0: 100, 1: 10, 2: 15}, 20)
    assert {(a, turn): slices for ways in routes.values() for a, _, slices, turn in ways if turn >= 0} == {(0, 1): 8, (0, 2): 8, (1, 2): 1}


@pytest.mark.parametrize("kind,name", [("string", lambda x: f"{x:05}"), ("long", lambda x: (x - 3) * (1 << 60)), ("int", lambda x: x - 9)])
def test_neighbours_of_items_and_users_of_other_types(spark, kind, name):
    rng = np.random.default_rng(6)
    rows = [(u, i, float(rng.integers(1, 9))) for u in range(7) for i in range(6) if rng.random() < 0.8]
    plain = spark.createDataFrame(rows, "user long, item long, rating double").cache()
    named = spark.createDataFrame([(name(u), name(i), r) for u, i, r in rows], f"user {kind}, item {kind}, rating double").cache()
    wanted = neighbour_lists(recommend.item_neighbours(plain, plain.select("item").distinct(), 4))
    got = neighbour_lists(recommend.all_item_neighbours(named, 4, item_block=2, unit_ratings=15))
    assert got == {name(t): [(name(i), s) for i, s in near] for t, near in wanted.items()}
