"""The most frequent words from guessed words and hashed counters, proved by the counters' upper bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.plans.stage import stage

# Counters for words that are not counted by name, guessed words per wanted word, and rows the guess looks at on average.
BUCKETS = 1 << 16
MARGIN = 4
SAMPLE_ROWS = 1000


def bucket(word: Column, buckets: int) -> Column:
    """The counter of a word."""
    return F.pmod(F.xxhash64(word), F.lit(buckets))


def guessed_words(spread: DataFrame, wanted: int) -> DataFrame:
    """(word): the ``wanted`` most frequent words of a sample. A guess only saves work; the result does not depend on it."""
    counts = spread.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(wanted)
    return stage(counts.select("word"), "guessed-words")


def counters(spread: DataFrame, guessed: DataFrame, buckets: int) -> DataFrame:
    """(word, bucket, n): the count of every guessed word by name, and of all other words together per counter."""
    marked = spread.join(F.broadcast(guessed.select(F.col("word").alias("name"))), F.col("word") == F.col("name"), "left")
    place = F.when(F.col("name").isNull(), bucket(F.col("word"), buckets)).alias("bucket")
    return marked.select("name", place).groupBy(F.col("name").alias("word"), "bucket").agg(F.count("*").alias("n"))


def most_frequent(rows: DataFrame, words: Column | str, k: int, buckets: int = BUCKETS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(word, n): the ``k`` most frequent elements of the arrays ``words``, a column or expression of ``rows``, exact; ties go to the smaller word.

    One pass counts the words that are frequent in a sample by name, and all others by hash in ``buckets`` counters. These
    counts add up over the tasks, so that at most ``buckets + MARGIN * k`` rows leave a task, however large the
    vocabulary. A counter bounds the count of each of its words from above. If none reaches the k-th count by
    name, no other word can be among the k best. Otherwise the words of the counters that reach it are counted by name,
    which settles it.
    """
    # The outer form, or Spark would make the words of every row once more to see whether it has any.
    spread = lambda some: some.select(F.explode_outer(words).alias("word")).where(F.col("word").isNotNull())
    share = min(1.0, sample_rows / max(rows.count(), 1))
    some = rows if share == 1.0 else rows.sample(share, seed=1)
    guessed = guessed_words(spread(some), MARGIN * k)
    counted = stage(counters(spread(rows), guessed, buckets), "word-counters")
    named = counted.where(F.col("word").isNotNull()).select("word", "n")
    best = named.orderBy(F.desc("n"), "word").limit(k)
    reached = best.agg(F.count("*").alias("words"), F.min("n").alias("least")).first()
    least = reached["least"] if reached["words"] == k else 0
    full = stage(counted.where(F.col("word").isNull() & (F.col("n") >= least)).select("bucket"), "full-counters")
    if full.isEmpty():
        return best
    others = spread(rows).join(F.broadcast(guessed), "word", "left_anti").withColumn("bucket", bucket(F.col("word"), buckets))
    more = others.join(full, "bucket", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    return named.unionByName(more).orderBy(F.desc("n"), "word").limit(k)
