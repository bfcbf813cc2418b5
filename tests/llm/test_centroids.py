import hashlib
import math
import random

import pytest

from lumenfold.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, kind string, cells string"


def table(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in vectors], schema)


def brute(vectors, clusters=16, rounds=3, width=64):
    kept = [(i, v) for i, v in vectors if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    rows = [(i, tuple(math.floor(64 * x) for x in v), v) for i, v in kept]
    named = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v, c) for i, c, v in rows)
    centres = [c for _, _, c in named[:clusters]]

    def nearest(c):
        return min((sum((a - b) ** 2 for a, b in zip(c, m, strict=True)), k) for k, m in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, c, _ in rows:
            members.setdefault(nearest(c)[1], []).append(c)
        centres = [
            tuple(sum(x) // len(members[k]) for x in zip(*members[k], strict=True)) if k in members else m for k, m in enumerate(centres)
        ]
    found = [(i, *nearest(c)) for i, c, _ in rows]
    names = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in centres]
    most = (1 << 63) - 1
    sums = {k: min(most, sum(min(most, d) for _, d, j in found if j == k)) for k in range(len(centres))}
    whole = min(most, sum(min(most, d) for _, d, _ in found))
    return sorted((str(i), k, min(most, d), sums[k], whole, names[k]) for i, d, k in found)


def run(spark, vectors, **more):
    got = centroids.cluster(table(spark, vectors), **more).collect()
    return sorted((str(r["vec_id"]), *tuple(r)[1:]) for r in got)


def near(rng, n, groups=8, width=64):
    middles = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(groups)]
    # Multiples of 1/4096 are the same in single and double precision.
    return [(i, [round((m + rng.gauss(0, 0.2)) * 4096) / 4096 for m in rng.choice(middles)]) for i in range(n)]


def test_equals_brute_force(spark):
    vectors = near(random.Random(1), 500)
    assert run(spark, vectors) == brute(vectors)


def test_odd_vectors_ties_and_copies(spark):
    rng = random.Random(2)
    vectors = near(rng, 60)
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None] * 64, [float("nan")] * 64, [float("inf")] + [0.0] * 63]
    vectors += [(100 + k, v) for k, v in enumerate(bad)] + [(None, [0.5] * 64)] + [(7, vectors[7][1])] * 30 + [(7, [0.25] * 64)] * 3
    assert run(spark, vectors) == brute(vectors)


def test_empty_clusters_keep_their_centroid(spark):
    vectors = [(i, [float(i % 3)] * 64) for i in range(40)]
    assert run(spark, vectors) == brute(vectors)


@pytest.mark.parametrize("top", [3e4, 1e10, 1e30])
def test_large_components_stay_exact(spark, top):
    rng = random.Random(3)
    vectors = [(i, [float(rng.randrange(-(1 << 20), 1 << 20)) * 2.0 ** int(math.log2(top / (1 << 20))) for _ in range(64)]) for i in range(50)]
    assert run(spark, vectors) == brute(vectors)


def test_few_vectors_none_and_other_parameters(spark):
    vectors = near(random.Random(4), 5)
    assert run(spark, vectors) == brute(vectors)
    assert run(spark, []) == [] and run(spark, [(1, [1.0])]) == []
    vectors = near(random.Random(5), 80, width=5)
    assert run(spark, vectors, clusters=4, rounds=6, width=5) == brute(vectors, 4, 6, 5)


def test_only_changes_are_multiplied():
    import numpy as np

    cells = np.arange(12.0).reshape(3, 4)
    before, after = np.array([1, 2, 3, 4], object), np.array([1, 2, 9, 4], object)
    at = np.flatnonzero(after != before)
    whole = centroids.product(cells, after)
    assert (centroids.product(cells, before) + centroids.product(cells[:, at], (after - before)[at]) == whole).all()
