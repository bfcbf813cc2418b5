import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lumenfold.functions import text as tx
from lumenfold.operators import corpus

TEXTS = [
    "The horse raced past the barn fell",
    "I burn, I pine, I perish",
    "Don't SHOUT don't! #tag @you a-b_c 12,5 it's",
    "",
    "   ",
    "no break em\x1cfile\x85next",
    "Élan élan ÀÉ straße ΟΔΟΣ ὈΔΥΣ",
    "KKelvin İstanbul iI kK",
    "日本語 テスト 日本",
    "𝒜𝒜 plane 1 letters",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


@pytest.mark.parametrize("partitions", [1, 7])
def test_word_count_equals_python_split(docs, partitions):
    want = Counter(w.lower() for t in TEXTS for w in t.split())
    got = {r["word"]: r["n"] for r in corpus.word_count(docs.repartition(partitions)).collect()}
    assert got == want


def letter_model(texts):
    counts = {}
    for t in texts:
        here = Counter(ch.lower() for ch in t if ch.isalpha())
        for c in "abcdefghijklmnopqrstuvwxyz":
            here.setdefault(c, 0)
        for c, n in here.items():
            counts.setdefault(c, []).append(n)
    result = {}
    for c, ns in counts.items():
        mean = round(sum(ns) / len(ns), 4)
        std = round(abs(sum(n * n for n in ns) / len(ns) - mean**2) ** 0.5, 4)
        result[c] = (float(sum(ns)), float(sum(n * n for n in ns)), len(ns), mean, std)
    return result


@pytest.mark.parametrize("partitions", [1, 7])
def test_letter_moments(docs, partitions):
    rows = corpus.letter_moments(docs.repartition(partitions)).collect()
    got = {r["letter"]: (r["total"], r["total_squares"], r["docs"], r["mean"], r["std"]) for r in rows}
    want = letter_model(TEXTS)
    assert got.keys() == want.keys()
    for letter, values in want.items():
        assert got[letter] == pytest.approx(values, abs=1.1e-4), letter


def test_tokens_equal_the_pattern(docs):
    pattern = re.compile(tx.TOKEN)
    rows = docs.select("text", tx.tokens(F.col("text")).alias("t"), tx.lower_all(tx.tokens(F.col("text"))).alias("l"))
    for r in rows.collect():
        want = re.findall(pattern, r["text"])
        assert r["t"] == want
        assert [w for w in r["l"] if w] == [w.lower() for w in want]


def test_run_lengths(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c", "b"],), ([],), (["x"],)], "v array<string>")
    got = [[(e["value"], e["n"]) for e in r[0]] for r in df.select(tx.run_lengths(F.col("v"))).collect()]
    assert got == [[("a", 1), ("b", 3), ("c", 1)], [], [("x", 1)]]


def test_word_counts_only_if_it_stands_in_lower_case(spark):
    reviews = spark.createDataFrame([(1, "Good good x"), (2, "GOOD Good"), (3, "good")], "doc_id long, text string")
    words = spark.createDataFrame([("good",)], "word string")
    got = {r["doc_id"]: r["frequency"] for r in corpus.word_frequencies(reviews, words).collect()}
    assert got == {1: pytest.approx(2 / 3), 3: 1.0}
    folded = corpus.word_frequencies(reviews, words, case_fold=True)
    assert {r["doc_id"]: r["frequency"] for r in folded.collect()} == {1: pytest.approx(2 / 3), 2: 1.0, 3: 1.0}


def test_top_tokens_ties_go_to_the_smaller_word(spark):
    reviews = spark.createDataFrame([(1, "b a c c"), (2, None)], "doc_id long, text string")
    assert [(r["word"], r["n"]) for r in corpus.top_tokens(reviews, 2).collect()] == [("c", 2), ("a", 1)]


def test_set_difference_modes(spark):
    r = spark.createDataFrame([("a",), ("a",), ("b",), ("",), ("c",)], "element string")
    s = spark.createDataFrame([("c",), ("d",)], "element string")
    single = corpus.set_difference(r, s).collect()
    assert sorted(x[0] for x in single) == ["", "b"]
    distinct = corpus.set_difference(r, s, mode="distinct").collect()
    assert sorted(x[0] for x in distinct) == ["", "a", "b"]
    assert [x[0] for x in corpus.set_intersection(r, s).collect()] == ["c"]
    zero = spark.createDataFrame([(0,), (1,), (1,)], "element long")
    assert [x[0] for x in corpus.set_difference(zero, zero.limit(0)).collect()] == [0]


def test_dense_to_coordinates(spark):
    m = spark.createDataFrame([("m", [[0.0, 2.0], [3.0, 0.0]])], "label string, m array<array<double>>")
    got = corpus.dense_to_coordinates(m, "label", F.col("m")).collect()
    assert sorted(tuple(r) for r in got) == [("m", 0, 1, 2.0), ("m", 1, 0, 3.0)]
