"""SimHash near-duplicates with pigeonring filtering.

A fingerprint has a bit set if over half of the hashes of the word shingles have it. Equal
fingerprints are one node. Two nodes link at ``TAU`` or fewer differing bits.

The 64 bits are a ring of ``SEGMENTS`` segments. If two fingerprints differ in at most TAU bits,
some segment starts a chain whose first l segments together differ in at most
l * TAU / SEGMENTS bits, for every l. With four segments and two bits: equal in the first, at
most one bit over the first two and three, two over all. The index is on chains of two segments: a node stands under
its own value of them, and looks under that value and the sixteen that differ from it in one bit of the second segment.
Pairs that meet there must pass the rest of the chain, and only then is the full distance counted.

Nodes that differ little crowd under one value of 32 bits. If more than ``BUCKET`` stand under a value, those who stand or look
there are not paired up. Each names its own other bits and all that differ from them in one; two nodes of equal first
segment share such a name exactly if they differ in two bits or fewer, and at most 49 nodes share one, so that links to the
smallest of them keep every connection. Distinct fingerprints that are not near copies do not crowd: four billion
values for each of the four places.

Links between distinct fingerprints make components by label propagation with pointer jumping,
one written table per round. No table that grows with the documents is broadcast: Spark takes the size of a table from its
compressed files and does not see that an explode makes seventeen rows of one. Rows: a null text has no words, so its fingerprint is zero. Rows with
equal ids keep one row each; null ids do not count as smallest unless there is no other.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import fresh
from lumenfold.plans.stage import stage

SHINGLE = 3
TAU = 2
SEGMENTS = 4
WIDTH = 64 // SEGMENTS
BUCKET = 64
SEED = 42
SLICE = 1 << 15
# Crowded values are broadcast up to so many, about 12 MB; at most one in BUCKET / SEGMENTS fingerprints makes one.
CROWDS = 100_000

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one whole text."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    bits, n, of = np.zeros(64, np.int64), len(words) - k + 1, xxhash.xxh64_intdigest
    for at in range(0, n, SLICE):
        a, b = starts[at : min(at + SLICE, n)].tolist(), ends[at + k - 1 : min(at + SLICE, n) + k - 1].tolist()
        hashes = np.fromiter((of(joined[x:y], SEED) for x, y in zip(a, b, strict=True)), np.uint64, len(a))
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > n, bitorder="little").tobytes(), "little", signed=True)


def with_fingerprint(docs: DataFrame, text: str, into: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of ``text`` as column ``into``."""

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())

    return docs.withColumn(into, prints(F.col(text).cast("string")))


def turned(fp: Column, place: Column) -> Column:
    """The fingerprint turned so that the segment at ``place`` comes first (lowest)."""
    by = (place * WIDTH).cast("int")
    return F.when(by == 0, fp).otherwise(
        F.call_function("shiftrightunsigned", fp, by).bitwiseOR(F.call_function("shiftleft", fp, F.lit(64) - by))
    )


def passes_chain(difference: Column, tau: int = TAU) -> Column:
    """Whether the first l segments of a turned difference keep within l * tau / SEGMENTS bits, for every l."""
    checks = []
    for l in range(1, SEGMENTS):  # noqa: E741
        low = F.bit_count(difference.bitwiseAND(F.lit((1 << (WIDTH * l)) - 1)))
        checks.append(low <= tau * l // SEGMENTS)
    return reduce(lambda a, b: a & b, checks) & (F.bit_count(difference) <= tau)


def sorted_side(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that shuffles and sorts both, whatever Spark takes for its size."""
    return df.hint("merge")


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b) between distinct fingerprints ``fp``: connected exactly as by all links of two bits or fewer."""
    places = prints.select("fp", F.explode(F.array(*[F.lit(p) for p in range(SEGMENTS)])).alias("place"))
    two = turned(F.col("fp"), F.col("place")).bitwiseAND(F.lit((1 << 2 * WIDTH) - 1))
    stands = stage(places.select("place", two.alias("value"), "fp"), "ring-places")
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(WIDTH, 2 * WIDTH)])
    looks = stands.select("place", F.explode(flips).alias("flip"), "value", F.col("fp").alias("fp2"))
    looks = looks.select("place", F.col("value").bitwiseXOR(F.col("flip")).alias("value"), "fp2")

    crowds = stands.groupBy("place", "value").agg(F.count("*").alias("n")).where(F.col("n") > bucket)
    crowds = stage(crowds.select("place", "value", F.lit(True).alias("crowd")), "crowds")
    number = crowds.count()
    some, crowds = number > 0, F.broadcast(crowds) if number <= CROWDS else sorted_side(crowds)
    alone = stands.join(crowds, ["place", "value"], "left_anti") if some else stands
    difference = turned(F.col("fp").bitwiseXOR(F.col("fp2")), F.col("place"))
    paired = alone.join(sorted_side(looks), ["place", "value"]).where((F.col("fp") < F.col("fp2")) & passes_chain(difference))
    direct = paired.select(F.col("fp").alias("a"), F.col("fp2").alias("b"))
    if not some:
        return direct.distinct()

    crowded = looks.join(crowds, ["place", "value"], "left_semi").select("place", F.col("fp2").alias("fp")).distinct()
    one_bit = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(WIDTH, 64)])
    names = crowded.select("place", "fp", F.explode(one_bit).alias("flip")).select(
        "place", turned(F.col("fp"), F.col("place")).bitwiseXOR(F.col("flip")).alias("name"), "fp"
    )
    shared = names.groupBy("place", "name").agg(F.collect_set("fp").alias("members")).where(F.size("members") > 1)
    starred = shared.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a <> b")
    return direct.unionAll(starred).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that is reachable, for every node of ``edges`` (a, b)."""
    both = stage(edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(sorted_side(labels), both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(sorted_side(near), labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        above = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        after = lower.join(sorted_side(above), "label", "left").select("node", "old", F.least("label", "jump").alias("label"))
        after = stage(after, "labels")
        moved = after.where("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not moved:
            return labels


def classes(rows: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(fp, label, component_id) for every fingerprint of ``rows`` (doc, fp)."""
    prints = stage(rows.groupBy("fp").agg(F.min("doc").alias("first")), "fingerprints")
    labels = components(links(prints.select("fp"), bucket))
    named = prints.join(sorted_side(labels.withColumnRenamed("node", "fp")), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    named = stage(named, "labelled-fingerprints")
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    return named.join(sorted_side(least), "label").select("fp", "label", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """Per document row: doc_id, fingerprint (16 hex digits), component_id."""
    rows = with_fingerprint(docs.select(F.col("doc_id").alias("doc"), "text"), "text", "fp", shingle).select("doc", "fp")
    rows = stage(rows, "document-fingerprints")
    joined = rows.join(sorted_side(classes(rows, bucket)), "fp")
    return joined.select(F.col("doc").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """One row of ``docs``, with all its columns, for each component: one with its smallest id.

    The rows are written with a row number first, so that repeated ids and rows can be told apart.
    """
    row, fp = fresh(docs, "row_number"), fresh(docs, "fingerprint")
    marked = docs.withColumn(row, F.monotonically_increasing_id())
    marked = stage(with_fingerprint(marked, "text", fp, shingle), "fingerprinted")
    rows = marked.select(F.col("doc_id").alias("doc"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    named = rows.join(sorted_side(classes(rows, bucket).select("fp", "label")), "fp")
    order = F.struct(F.col("doc").isNull().alias("missing"), "doc", "row")
    kept = named.groupBy("label").agg(F.min(order).alias("best")).select(F.col("best.row").alias(row))
    return marked.join(kept, row, "left_semi").drop(row, fp)
