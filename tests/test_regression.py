import math
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lumenfold.functions.stats import two_sided_p
from lumenfold.functions.text import TOKEN
from lumenfold.operators import corpus, regression
from lumenfold.sources import read_reviews


def tail(t, df):
    """Two-sided tail by integrating the density over the angle."""
    theta = np.linspace(math.atan(abs(t) / math.sqrt(df)), math.pi / 2, 400_001)
    values = np.cos(theta) ** (df - 1)
    step = theta[1] - theta[0]
    area = step / 3 * (values[0] + values[-1] + 4 * values[1:-1:2].sum() + 2 * values[2:-1:2].sum())
    return 2 * area * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi)


def p_of(spark, pairs):
    df = spark.createDataFrame([(float(t), int(d)) for t, d in pairs], "t double, df long")
    return [r[0] for r in df.coalesce(1).select(two_sided_p(F.col("t"), F.col("df"))).collect()]


def test_tail_against_integration(spark):
    pairs = [(t, d) for t in (0.0, 0.01, 0.3, 0.99, 1.0, 1.5, -2.5, 6.0, 20.0) for d in (1, 2, 3, 10, 100, 397)]
    for (t, d), got in zip(pairs, p_of(spark, pairs)):
        assert got == pytest.approx(tail(t, d), rel=1e-8), (t, d)


def test_tail_closed_forms(spark):
    ts = [0.2, 1.0, 3.0, 50.0]
    assert p_of(spark, [(t, 1) for t in ts]) == pytest.approx([2 / math.pi * math.atan(1 / t) for t in ts], rel=1e-11)
    normal = p_of(spark, [(t, 10**12) for t in (0.5, 1.0, 4.0, 8.0)])
    assert normal == pytest.approx([math.erfc(t / math.sqrt(2)) for t in (0.5, 1.0, 4.0, 8.0)], rel=1e-8)


def test_tail_edges(spark):
    got = p_of(spark, [(math.inf, 5), (-math.inf, 5), (0.0, 5), (1.0, 0), (math.nan, 5), (300.0, 397)])
    assert got[:3] == [0.0, 0.0, 1.0] and got[3] is None and got[4] is None and 0 <= got[5] < 1e-300


REVIEWS = [
    (1, "good good Fine book", 5.0, True),
    (2, "bad book, bad end", 1.0, False),
    (3, "GOOD but Good only", 4.0, True),
    (4, "fine end . good", 3.0, True),
    (5, "", 2.0, False),
    (6, None, 5.0, True),
    (7, "book book bad", None, True),
    (8, "good end", 5.0, None),
    (9, "only good and bad", 4.0, False),
]


def frequencies(words, missing, case_fold=False):
    x, y, c = [], [], []
    for _, text, rating, verified in REVIEWS:
        if text is None or rating is None or verified is None:
            if missing == "zero":
                x.append([0.0] * len(words)), y.append(0.0), c.append(0.0)
            continue
        found = re.findall(TOKEN, text)
        low = [w.lower() for w in found]
        x.append([low.count(w) / len(found) if w in (low if case_fold else found) else 0.0 for w in words])
        y.append(rating), c.append(float(verified))
    return np.array(x), np.array(y), np.array(c)


def ols(columns, y, se):
    z = [(v - v.mean()) / v.std() for v in columns]
    target = (y - y.mean()) / y.std()
    design = np.column_stack([*z, np.ones(len(y))])
    beta, *_ = np.linalg.lstsq(design, target, rcond=None)
    df = len(y) - design.shape[1]
    s2 = np.sum((target - design @ beta) ** 2) / df
    error = math.sqrt(s2 / len(y)) if se == "simple" else math.sqrt(s2 * np.linalg.inv(design.T @ design)[0, 0])
    return beta[0], tail(beta[0] / error, df)


@pytest.mark.parametrize("missing", ["zero", "drop"])
@pytest.mark.parametrize("control,se", [(None, "simple"), ("verified", "simple"), ("verified", "ols")])
@pytest.mark.parametrize("partitions", [1, 5])
def test_word_regressions_equal_least_squares(spark, missing, control, se, partitions):
    words = ["good", "bad", "book", "fine", "end"]
    reviews = spark.createDataFrame(REVIEWS, "doc_id long, text string, rating double, verified boolean")
    got = regression.word_regressions(
        reviews.repartition(partitions),
        control=control,
        words=spark.createDataFrame([(w,) for w in words], "word string"),
        tests=10,
        missing=missing,
        required=["verified"],
        se=se,
    )
    rows = {r["word"]: r for r in got.collect()}
    x, y, c = frequencies(words, missing)
    for k, word in enumerate(words):
        beta, p = ols([x[:, k]] + ([c] if control else []), y, se)
        assert rows[word]["n"] == len(y)
        assert rows[word]["beta"] == pytest.approx(beta, abs=1e-10), word
        assert rows[word]["p"] == pytest.approx(10 * p, rel=1e-6), word


def test_unseen_word_has_no_slope_and_p_may_be_clipped(spark):
    reviews = spark.createDataFrame(REVIEWS, "doc_id long, text string, rating double, verified boolean")
    words = spark.createDataFrame([("absent",), ("good",)], "word string")
    rows = {r["word"]: r for r in regression.word_regressions(reviews, words=words, tests=1000, clip=True).collect()}
    assert rows.get("absent") is None or rows["absent"]["beta"] is None
    assert rows["good"]["p"] == 1.0


def test_feature_regressions(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=60), rng.normal(size=60)
    y = 2 * a - 0.5 * b + rng.normal(size=60)
    df = spark.createDataFrame([(float(p), float(q), 7.0, float(z)) for p, q, z in zip(a, b, y)], "a double, b double, flat double, y double")
    got = {r["feature"]: r for r in regression.feature_regressions(df, ["a", "b", "flat", "y"], "y", include_target=True).collect()}
    for name, x in (("a", a), ("b", b)):
        beta, p = ols([x], y, "simple")
        assert got[name]["beta"] == pytest.approx(beta) and got[name]["p"] == pytest.approx(p, rel=1e-6)
    assert got["flat"]["beta"] is None and got["flat"]["p"] is None
    assert got["y"]["beta"] == 1.0 and got["y"]["p"] == 0.0
    without = regression.feature_regressions(df, ["a", "b", "flat", "y"], "y")
    assert {r["feature"] for r in without.collect()} == {"a", "b", "flat"}


def test_both_ends_skip_null_and_nan(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", None), ("d", math.nan), ("e", -1.0)], "k string, s double")
    rows = regression.both_ends(df, "s", ["k"], 2).collect()
    assert [(r["side"], r["k"]) for r in rows] == [("top", "a"), ("top", "b"), ("bottom", "e"), ("bottom", "a")]


def test_number_of_tests_is_that_of_the_given_words(spark):
    reviews = spark.createDataFrame(REVIEWS, "doc_id long, text string, rating double, verified boolean")
    words = spark.createDataFrame([("good",), ("bad",)], "word string")
    adjusted, single = (
        {r["word"]: r["p"] for r in regression.word_regressions(reviews, words=words, tests=n).collect()} for n in (None, 1)
    )
    assert adjusted["good"] == pytest.approx(2 * single["good"])


def test_rows_with_equal_ids_stay_apart_and_need_no_id(spark):
    reviews = spark.createDataFrame([(i % 6, "good x" if i % 4 else "x", float(i)) for i in range(12)], "doc_id long, text string, rating double")
    row = regression.word_regressions(reviews.drop("doc_id")).where("word = 'good'").first()
    assert row["n"] == 12


def test_regression_of_a_review_file(spark, tmp_path):
    lines = [f'{{"reviewText":"good day {i}","overall":{i % 5}.0,"verified":{"true" if i % 2 else "false"}}}' for i in range(20)]
    (tmp_path / "r.json").write_text("\n".join([*lines, '{"overall":1}']))
    reviews = read_reviews(spark, str(tmp_path / "r.json"))
    rows = regression.word_regressions(reviews, text="reviewText", target="overall", control="verified").collect()
    assert {r["n"] for r in rows} == {21}


def test_counting_takes_memory_by_portions_not_by_batches():
    rows = [["good", "Bad", "other", "good"] * 100] * 5_000 + [None, [], ["bad"] * 300_000]
    batch = pa.RecordBatch.from_pydict({"tokens": rows, "length": pa.array([len(r or []) for r in rows], pa.int32())})
    tracemalloc.start()
    parts = list(corpus.count_chosen(iter([batch]), ["bad", "good"], []))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = pa.Table.from_batches(parts).to_pylist()
    assert [r["length"] for r in found] == [len(r or []) for r in rows]
    wanted = [{"word": "bad", "n": 100, "in_lower": False}, {"word": "good", "n": 200, "in_lower": True}]
    assert all(r["words"] == wanted for r in found[:5_000])
    assert [r["words"] for r in found[5_000:]] == [[], [], [{"word": "bad", "n": 300_000, "in_lower": True}]]
    assert peak < 40e6
