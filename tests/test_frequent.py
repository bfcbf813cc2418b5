import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lumenfold.operators import frequent


def table(spark, lists, partitions=5):
    return spark.createDataFrame([(x,) for x in lists], "words array<string>").repartition(partitions)


def zipf(rng, n, vocabulary):
    weights = [1 / (r + 1) for r in range(vocabulary)]
    return [f"w{w}" for w in rng.choices(range(vocabulary), weights, k=n)]


def exact(lists, k):
    counts = Counter(w for x in lists for w in x or [] if w is not None)
    return sorted(counts.items(), key=lambda p: (-p[1], p[0]))[:k]


def found(df):
    return sorted(((r["word"], r["n"]) for r in df.collect()), key=lambda p: (-p[1], p[0]))


@pytest.mark.parametrize("buckets,sample_rows", [(frequent.BUCKETS, 2000), (300, 5), (50, 1), (1, 20)])
def test_equals_exact_counts_with_any_guess(spark, buckets, sample_rows):
    rng = random.Random(1)
    lists = [zipf(rng, 60, 3000) for _ in range(200)] + [None, [], [None, "w0"]]
    assert found(frequent.most_frequent(table(spark, lists), "words", 10, buckets, sample_rows)) == exact(lists, 10)


def test_a_bad_guess_is_settled_by_a_second_count(spark, monkeypatch):
    """The guessed words are the rarest ones, and all counts are equal but few, so the proof fails."""
    lists = [[f"w{(7 * i + j) % 300:03}" for j in range(30)] for i in range(300)] + [["rare"]]
    guess = spark.createDataFrame([("rare",), ("absent",)], "word string")
    monkeypatch.setattr(frequent, "guessed_words", lambda spread, wanted: guess)
    assert found(frequent.most_frequent(table(spark, lists), "words", 5, 97)) == exact(lists, 5)


def test_counters_bound_their_words_and_their_number_is_bounded(spark):
    rng = random.Random(2)
    lists = [zipf(rng, 100, 5000) for _ in range(150)]
    words = table(spark, lists).select(F.explode("words").alias("word"))
    guess = spark.createDataFrame([("w0",), ("w1",)], "word string")
    rows = frequent.counters(words, guess, 64).collect()
    counts = Counter(w for x in lists for w in x)
    assert len(rows) <= 66 and {r["word"]: r["n"] for r in rows if r["word"]} == {w: counts[w] for w in ("w0", "w1")}
    place = {r["word"]: r["b"] for r in words.distinct().withColumn("b", frequent.bucket(F.col("word"), 64)).collect()}
    bound = {r["bucket"]: r["n"] for r in rows if r["word"] is None}
    assert all(n <= bound[place[w]] for w, n in counts.items() if w not in ("w0", "w1"))


def test_the_vocabulary_is_not_shuffled(spark, monkeypatch):
    """Few frequent words among many rare ones: no more rows than counters and guesses leave the counting."""
    rng = random.Random(3)
    lists = [["a", "b", "c"] * 20 + [f"rare{rng.randrange(10**9)}" for _ in range(40)] for _ in range(200)]
    seen, stage = {}, frequent.stage
    monkeypatch.setattr(frequent, "stage", lambda df, name: seen.setdefault(name, stage(df, name)))
    assert found(frequent.most_frequent(table(spark, lists, 4), "words", 3, 500)) == exact(lists, 3)
    assert seen["word-counters"].count() <= 500 + 3 * frequent.MARGIN and seen["full-counters"].isEmpty()


def test_empty_and_fewer_words_than_wanted(spark):
    assert found(frequent.most_frequent(table(spark, [["x", "y", "x"]]), "words", 9)) == [("x", 2), ("y", 1)]
    assert found(frequent.most_frequent(table(spark, [None]).where(F.lit(False)), "words", 9)) == []
