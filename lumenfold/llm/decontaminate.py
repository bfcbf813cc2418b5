"""Benchmark decontamination with a positional inverted index.

Words are runs of letters and digits in ASCII and of any other character, with A-Z in
lower case. A phrase is ``size`` consecutive words of a benchmark item; an item of fewer
words, but not none, is one phrase.

1. Count, over the whole corpus, every term that the phrases use. A phrase with a term
   that never occurs is dropped.
2. Store the postings (text, term, position) of the two rarest terms of each phrase. The
   postings of the rarest term also hold the words around it.
3. Intersect both lists with their offsets taken off: equal starts are phrase candidates,
   starts at most ``slack`` apart are proximity matches.
4. Compare the remaining words of a candidate with the words around the rarest term.

Postings are kept per distinct text, so copies of a text cost one list, not one per row
and never a product of rows. Terms go to the scan as a broadcast of checked size, in
blocks beyond it. Nulls: a text or item that is null has no words; an item whose id is null
counts as the item ''. Rows with equal ids are judged each by its own text. Extra columns are
ignored; an empty table of items leaves every document clean.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lumenfold.llm.common import byte_blocks, digest, fresh, lower_ascii
from lumenfold.plans.stage import stage

SIZE = 10
SLACK = 3
# Starts are compared within cells of so many words, so that a long text does not meet itself as a whole.
CELL = 64
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def tokens(text: Column) -> Column:
    """Words of a text in order."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), BREAK, -1), "")


def phrases(items: DataFrame, size: int = SIZE, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, phrase, n): the distinct phrases of every item, words joined by a blank."""
    words = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), tokens(F.col(text)).alias("words"))
    last = F.greatest(F.size("words") - size, F.lit(0))
    starts = words.where(F.size("words") > 0).select("item", "words", F.explode(F.sequence(F.lit(1), last + 1)).alias("at"))
    cut = starts.select("item", F.slice("words", F.col("at"), size).alias("cut"))
    return cut.select("item", F.array_join("cut", " ").alias("phrase"), F.size("cut").alias("n")).distinct()


def term_counts(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, rows): how often each term stands in ``texts`` (text)."""
    # The outer form, or Spark would split every text once more to see whether it has words.
    words = texts.select(F.explode_outer(tokens(F.col("text"))).alias("term"))
    parts = [words.join(block, "term").groupBy("term").agg(F.count("*").alias("rows")) for block in byte_blocks(terms, "term")]
    return reduce(DataFrame.unionAll, parts)


def rarest_terms(phrase_list: DataFrame, counts: DataFrame) -> DataFrame:
    """(phrase, n, term, offset, term2, offset2): the rarest term and the next, which is the same for one word."""
    parts = phrase_list.select("phrase", "n", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    counted = parts.join(counts, "term", "left")
    order = W.partitionBy("phrase").orderBy(F.coalesce("rows", F.lit(0)), "term", "offset")
    ranked = counted.withColumn("rank", F.row_number().over(order)).where("rank <= 2")
    first, second = F.col("rank") == 1, F.col("rank") == 2
    pick = lambda c, which: F.max(F.when(which, F.col(c)))
    both = ranked.groupBy("phrase", "n").agg(
        pick("term", first).alias("term"),
        pick("offset", first).alias("offset"),
        F.coalesce(pick("term", second), pick("term", first)).alias("term2"),
        F.coalesce(pick("offset", second), pick("offset", first)).alias("offset2"),
        pick("rows", first).alias("rows"),
    )
    return both.where("rows > 0").drop("rows")


def postings(texts: DataFrame, rare: DataFrame, size: int = SIZE) -> DataFrame:
    """(digest, term, at, back, around) for the terms of ``rare``, once per distinct text.

    ``around`` holds up to ``size - 1`` words on either side of a term that is the rarest of a
    phrase; ``back`` says how many stand before it.
    """
    terms = rare.select("term", F.lit(True).alias("rarest")).unionAll(rare.select(F.col("term2"), F.lit(False)))
    terms = terms.groupBy("term").agg(F.max("rarest").alias("rarest"))
    words = texts.select("digest", tokens(F.col("text")).alias("words"))
    spread = words.select("digest", "words", F.posexplode_outer("words").alias("at", "term"))
    back = F.least(F.col("at"), F.lit(size - 1))
    around = F.array_join(F.slice("words", F.col("at") - back + 1, back + size), " ")
    parts = [
        spread.join(block, "term").select(
            "digest", "term", "at", back.alias("back"), F.when(F.col("rarest"), around).alias("around")
        )
        for block in byte_blocks(terms, "term")
    ]
    return reduce(DataFrame.unionAll, parts).dropDuplicates(["digest", "term", "at"])


def matches(
    docs: DataFrame, items: DataFrame, size: int = SIZE, slack: int = SLACK, text: str = "text", item: str = "item_id"
) -> DataFrame:
    """(digest, item, start, n, exact): phrases found, and those whose two rarest terms are near each other."""
    texts = docs.where(F.col(text).isNotNull()).select(digest(F.col(text)).alias("digest"), F.col(text).alias("text"))
    listed = stage(phrases(items, size, item, "text"), "phrases")
    unique = listed.select("phrase", "n").distinct()
    terms = unique.select(F.explode(F.split("phrase", " ")).alias("term")).distinct()
    rare = stage(rarest_terms(unique, term_counts(texts, terms)), "rare-terms")
    index = stage(postings(texts, rare, size), "postings")

    first = index.join(rare, "term").select(
        "digest", "phrase", "n", "offset", "back", "around", (F.col("at") - F.col("offset")).alias("start")
    )
    first = first.withColumn("cell", F.floor(F.col("start") / CELL))
    begin2 = (F.col("at") - F.col("offset2")).alias("start2")
    second = index.join(rare.select("phrase", "offset2", F.col("term2").alias("term")), "term").select("digest", "phrase", begin2)
    spread = F.sequence(F.floor((F.col("start2") - slack) / CELL), F.floor((F.col("start2") + slack) / CELL))
    second = second.withColumn("cell", F.explode(spread))
    near = first.join(second, ["digest", "phrase", "cell"]).where(F.abs(F.col("start") - F.col("start2")) <= slack)
    found = F.slice(F.split("around", " "), F.greatest(F.col("back") - F.col("offset"), F.lit(0)) + 1, F.col("n"))
    exact = (F.col("start") == F.col("start2")) & (F.col("start") >= 0) & (F.array_join(found, " ") == F.col("phrase"))
    hits = near.groupBy("digest", "phrase", "n", "start").agg(F.max(exact).alias("exact"))
    return stage(hits.join(listed.select("phrase", "item"), "phrase").select("digest", "item", "start", "n", "exact"), "matches")


def contamination(
    docs: DataFrame, items: DataFrame, size: int = SIZE, slack: int = SLACK, text: str = "text", item: str = "item_id"
) -> DataFrame:
    """(digest, n_hit, items, n_near) per distinct text with a phrase or proximity match.

    ``n_hit`` counts the words inside any exact phrase; ``items`` are those found exactly, sorted
    as strings; ``n_near`` counts items that only come near.
    """
    found = matches(docs, items, size, slack, text, item)
    exact = found.where("exact")
    spans = exact.select("digest", "start", "n").distinct()
    covered = spans.select("digest", F.explode(F.expr("sequence(start, start + n - 1)")).alias("at")).distinct()
    hit = covered.groupBy("digest").agg(F.count("*").alias("n_hit"))
    per_item = found.groupBy("digest", "item").agg(F.max("exact").alias("exact"))
    listed = per_item.groupBy("digest").agg(
        F.sort_array(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("items"),
        F.count(F.when(~F.col("exact"), 1)).alias("n_near"),
    )
    return listed.join(hit, "digest", "left")


def document_hits(docs: DataFrame, items: DataFrame, size: int = SIZE, slack: int = SLACK) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near."""
    # Written first: then the join below is a plain one, in which Spark can split a digest with many copies.
    found = stage(contamination(docs, items, size, slack), "contamination")
    rows = docs.select(
        "doc_id", digest(F.col("text")).alias("digest"), F.size(tokens(F.col("text"))).cast("long").alias("n_words")
    )
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(found, "digest", "left").select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = SIZE, slack: int = SLACK) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no phrase of an item."""
    key = fresh(docs, "text_digest")
    hit = contamination(docs, items, size, slack).where("n_hit > 0").select(F.col("digest").alias(key))
    # Written first: Spark knows its size, and whole texts are only shuffled if it is too large to broadcast.
    hit = stage(hit, "contaminated")
    return docs.withColumn(key, digest(F.col("text"))).join(hit, key, "left_anti").drop(key)
