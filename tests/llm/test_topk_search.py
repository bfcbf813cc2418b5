import math
import random

from lumenfold.llm import topk_search

SCHEMA = "vec_id long, embedding array<float>, row string, grp string"


def brute(rows, k=20, every=20):
    good = [
        (i, n, [math.floor(64 * x) for x in v])
        for n, (i, v) in enumerate(rows)
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for qi, qn, q in good:
        if qi % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), i) for i, n, v in good if n != qn)[:k]
            out += [(qi, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def run(spark, rows, **options):
    found = topk_search.search(spark.createDataFrame([(i, v, "r", "g") for i, v in rows], SCHEMA), **options)
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


def vectors(n, seed, spread=1.0):
    rng = random.Random(seed)
    quarter = lambda: round(rng.uniform(-spread, spread) * 4) / 4  # noqa: E731  many ties
    return [(i, [quarter() for _ in range(8)]) for i in range(n)]


def test_equals_brute_force_over_rounds(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "FIRST", 1)
    rows = vectors(300, 3)
    assert run(spark, rows, block=7, group=40) == brute(rows)


def test_odd_vectors(spark):
    rows = vectors(30, 4)
    rows += [(31, None), (32, [None] * 8), (33, [float("nan")] * 8), (40, [float("inf")] * 8), (None, [1.0] * 8), (60, []), (41, [1.0] * 3)]
    rows += [(20, [0.5] * 8), (20, [0.5] * 8), (5, rows[5][1])]
    assert run(spark, rows, block=4, group=16) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**40 + i * 2**20), -float(2**39)]) for i in range(45)]
    got, want = run(spark, rows, block=8), brute(rows)
    top = (1 << 63) - 1
    assert got == [(q, r, v, max(min(s, top), -top - 1)) for q, r, v, s in want]


def test_few_and_no_vectors(spark):
    assert run(spark, []) == []
    assert run(spark, [(20, [1.0])]) == []
    assert run(spark, [(20, [1.0]), (1, [2.0])]) == [(20, 1, 1, 64 * 128)]
