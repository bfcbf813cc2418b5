"""Counting words, tokens and letters of a corpus, and set difference."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.functions import text as tx
from lumenfold.operators.frequent import most_frequent
from lumenfold.plans.stage import stage

# Fixed value: how many of the most frequent words are looked at.
TOP = 1000
# Tokens of a batch that are handled at once, so that memory does not grow with rows and texts.
TOKENS_AT_ONCE = 100_000


def word_count(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): white-space separated words in lower case, punctuation kept."""
    words = docs.select(F.explode(tx.lower_words(F.col(text))).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


def letter_moments(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per letter: moments of its count per document.

    The letters a-z count zero in documents without them; any other letter is
    measured over the documents that hold it. The counting is done inside each row,
    so only per-letter partial sums are shuffled. ``std`` uses the rounded mean.
    """
    parts = docs.select(
        tx.lower_text(F.coalesce(text, F.lit(""))).alias("plain"),
        tx.run_lengths(tx.other_letters(F.coalesce(text, F.lit("")))).alias("others"),
    )
    letters = F.array(*[F.lit(c) for c in tx.LETTERS])
    plain = F.zip_with(letters, tx.letter_counts(F.col("plain")), lambda c, n: F.struct(c.alias("value"), n.alias("n")))
    counts = parts.select(F.explode(F.concat(plain, "others")).alias("c")).select(
        F.col("c.value").alias("letter"), F.col("c.n").cast("double").alias("n")
    )
    sums = counts.groupBy("letter").agg(
        F.sum("n").alias("total"),
        F.sum(F.col("n") * F.col("n")).alias("total_squares"),
        F.count("*").alias("docs"),
    )
    with_mean = sums.withColumn("mean", F.round(F.col("total") / F.col("docs"), 4))
    variance = F.col("total_squares") / F.col("docs") - F.col("mean") * F.col("mean")
    return with_mean.withColumn("std", F.round(F.sqrt(F.abs(variance)), 4))


def token_counts(reviews: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): tokens of the whole corpus in lower case."""
    token_rows = reviews.select(tx.tokens(F.col(text)).alias("tokens"))
    words = token_rows.select(F.explode(tx.lower_all(F.col("tokens"))).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


def top_tokens(reviews: DataFrame, k: int = TOP, text: str = "text") -> DataFrame:
    """The ``k`` most frequent tokens, in lower case; ties go to the smaller word.

    Found by summaries of bounded size, so the vocabulary is not shuffled.
    """
    return most_frequent(reviews, F.array_remove(tx.lower_all(tx.tokens(F.col(text))), ""), k)


def portions(batch: pa.RecordBatch, column: str, elements: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in order, with at most about ``elements`` elements of the lists ``column`` at a time, and one row at least."""
    upto = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(), dtype=np.int64)
    at = 0
    while at < len(batch):
        before = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + elements, side="right")))
        yield batch.slice(at, end - at)
        at = end


def count_chosen(batches: Iterator[pa.RecordBatch], chosen: Sequence[str], carry: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The counts of :func:`counted` for rows with ``tokens`` and ``length``, some rows at a time."""
    known = pa.array(chosen, pa.string())
    for batch in (part for whole in batches for part in portions(whole, "tokens", TOKENS_AT_ONCE)):
        tokens = batch.column("tokens")
        flat = tokens.flatten()
        row = np.repeat(np.arange(len(batch)), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy())
        low = pc.ascii_lower(flat)
        code = pc.fill_null(pc.index_in(low, value_set=known), -1).to_numpy()
        there = code >= 0
        key = row[there] * max(len(chosen), 1) + code[there]
        same = pc.fill_null(pc.equal(low, flat), False).to_numpy(zero_copy_only=False)[there]
        keys, place, n = np.unique(key, return_inverse=True, return_counts=True)
        in_lower = np.bincount(place, weights=same, minlength=len(keys)) > 0
        of_row, of_word = np.divmod(keys, max(len(chosen), 1))
        offsets = np.searchsorted(of_row, np.arange(len(batch) + 1)).astype(np.int32)
        values = pa.StructArray.from_arrays(
            [known.take(pa.array(of_word, pa.int64())), pa.array(n, pa.int64()), pa.array(in_lower, pa.bool_())],
            names=["word", "n", "in_lower"],
        )
        columns = [*(batch.column(c) for c in carry), batch.column("length"), pa.ListArray.from_arrays(offsets, values)]
        yield pa.RecordBatch.from_arrays(columns, names=[*carry, "length", "words"])


def counted(reviews: DataFrame, words: Sequence[str], text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(carried columns, length, words): number of tokens, and (word, n, in_lower) of the given words in each row.

    ``in_lower`` says whether the word also stands there all in lower case. Counting happens inside the row, batch by
    batch, so rows need no id and nothing is shuffled; other words leave no trace. ``words`` is a short list.
    """
    chosen = sorted(set(words))
    rows = reviews.select(*carry, tx.tokens(F.col(text)).alias("tokens")).withColumn("length", F.size("tokens"))

    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in [*carry, "length"])
    return rows.mapInArrow(lambda batches: count_chosen(batches, chosen, carry), f"{kept}, words array<struct<word:string,n:bigint,in_lower:boolean>>")


def counted_top(reviews: DataFrame, k: int = TOP, text: str = "text", carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The ``k`` most frequent words, and the rows counted for them, both staged."""
    words = stage(top_tokens(reviews, k, text), "words")
    chosen = [r["word"] for r in words.select("word").collect()]
    return words, stage(counted(reviews, chosen, text, carry), "counted")


def counted_frequencies(rows: DataFrame, words: DataFrame, carry: Sequence[str] = (), case_fold: bool = False) -> DataFrame:
    """(carried columns, word, frequency) of counted rows for the given words, non-zero entries only.

    A word counts in a row only if it also stands there all in lower case, unless ``case_fold`` is set.
    ``words`` is a short list, which Spark broadcasts.
    """
    spread = rows.select(*carry, "length", F.explode_outer("words").alias("w"))
    kept = spread.where("w IS NOT NULL") if case_fold else spread.where("w.in_lower")
    frequency = F.try_divide(F.col("w.n"), F.col("length")).alias("frequency")
    return kept.select(*carry, F.col("w.word").alias("word"), frequency).join(words.select("word"), "word")


def word_frequencies(
    reviews: DataFrame, words: DataFrame, doc: str = "doc_id", text: str = "text", case_fold: bool = False
) -> DataFrame:
    """(doc, word, frequency) for the given words, each row of ``reviews`` by itself. ``words`` is a short list."""
    chosen = [r["word"] for r in words.select("word").distinct().collect()]
    found = counted_frequencies(counted(reviews, chosen, text, [doc]), words, [doc], case_fold)
    return found.select(doc, "word", "frequency")


def set_difference(r: DataFrame, s: DataFrame, element: str = "element", mode: str = "single") -> DataFrame:
    """Elements of ``r`` that are not in ``s``.

    ``single`` keeps an element only if its one occurrence in both inputs together is
    in ``r``; ``distinct`` keeps each element of ``r`` that ``s`` lacks, once.
    """
    if mode not in ("single", "distinct"):
        raise ValueError("mode is 'single' or 'distinct'")
    only_r = _membership(r, s, element).where("in_r AND NOT in_s")
    return (only_r.where("n = 1") if mode == "single" else only_r).select(element)


def set_intersection(r: DataFrame, s: DataFrame, element: str = "element") -> DataFrame:
    """Elements that occur in both inputs, once each."""
    return _membership(r, s, element).where("in_r AND in_s").select(element)


def _membership(r: DataFrame, s: DataFrame, element: str) -> DataFrame:
    """(element, n, in_r, in_s), combined before the one shuffle, however often an element occurs."""
    labelled = r.select(element, F.lit(True).alias("from_r")).unionAll(s.select(element, F.lit(False).alias("from_r")))
    return labelled.groupBy(element).agg(
        F.count("*").alias("n"), F.max("from_r").alias("in_r"), (~F.min("from_r")).alias("in_s")
    )


def dense_to_coordinates(matrix: DataFrame, label: str, cells: Column) -> DataFrame:
    """(label, i, j, v) for the non-zero cells of one array of rows per label."""
    rows = matrix.select(label, F.posexplode(cells).alias("i", "row"))
    flat = rows.select(label, "i", F.posexplode("row").alias("j", "v"))
    return flat.where("v <> 0").select(
        label, F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("v").cast("double").alias("v")
    )
