"""Sum-of-squares packing of tokenized documents into sequences of fixed capacity.

Every document becomes its token ids and a closing id; one that is longer than the capacity is
cut into full pieces, the first of which may be shorter. A piece is placed where the sum
of the squared numbers of open sequences per residual gap becomes smallest; of equal
places, the one with the smallest gap.

Only the length of a piece matters for its place. So the plan is made on the histogram of
lengths, at most ``capacity`` numbers, whatever the corpus. The plan says, for
intervals of the rank of a piece among those of its length, which sequences and offsets
it gets; it has a few rows per length, so it is small enough to broadcast. Ranks come from the
counts per input partition and length, so no key is gathered in one task.

A null text is an empty one: only the closing id. Equal ids and repeated rows are pieces of
their own. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lumenfold.plans.stage import stage

CAPACITY = 2048
CLOSING_ID = 0
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PORTIONS = 16
RANK_SPACE = 1 << 44


def cut_points(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def encoder(spec: str, rank_lines: bytes, split: str = public_tokenizers.PATTERN):
    """Text to ids, from the contents of the two files. The ranks are the same vocabulary and give the same ids several times
    faster; texts that hold a special token go to the tokenizer itself."""
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_str(spec)
    special = [t.content for t in slow.get_added_tokens_decoder().values()]
    merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_lines.splitlines())}
    fast = tiktoken.Encoding("ranks", pat_str=split, mergeable_ranks=merges, special_tokens={})

    def ids(text: str) -> list[int]:
        if any(s in text for s in special):
            return slow.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return ids


def pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    ranks: str = RANKS,
    closing: int = CLOSING_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth[, ids]) of every piece of every document row.

    ``nth`` counts the pieces of the same length that the task ``part`` has made before.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    # The contents, a few MB, go to the tasks: executors need no file.
    spec, rank_lines = Path(tokenizer).read_text(), Path(ranks).read_bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(spec, rank_lines), np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            row, out, ids = [], [], []
            for r, text in enumerate(batch.column(1)):
                whole = np.array([*encode(text.as_py() or ""), closing], "<u4")
                for k, (start, length) in enumerate(cut_points(len(whole), capacity)):
                    ends = whole[start : start + length]
                    row.append(r)
                    out.append((k, start, length, zlib.crc32(ends.tobytes()), part, int(seen[length])))
                    seen[length] += 1
                    if with_ids:
                        ids.append(ends.astype(np.int64))
            table = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types]
            columns = [batch.column(0).take(pa.array(row, pa.int64())), *table]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", *["ids"] * with_ids]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids array<long>" * with_ids
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first sequence, offset): runs of pieces that go to runs of sequences.

    Lengths come from long to short. Putting a piece of length l in a sequence with gap g
    changes the sum of squares by 2 * (N[g - l] - N[g]) + 2, or by 1 - 2 * N[g] if it fills
    the gap. A new sequence is opened only if no open one has room. The pieces of one length go in portions: as
    many as leave the best place the best, but at least a PORTIONS-th of the length's
    pieces, so that the number of steps does not grow with the corpus. No more sequences are
    opened at once than the pieces that are left can fill, or one.
    """
    count = np.zeros(capacity + 1, np.int64)
    runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    rows, used, never = [], 0, np.iinfo(np.int64).max
    for length in sorted(histogram, reverse=True):
        rank, rest, least = 0, histogram[length], -(-histogram[length] // PORTIONS)
        while rest:
            there = count[length:capacity]
            change = np.where(there > 0, 2 * (count[: capacity - length] - there) + 2, never)
            if length < capacity and there[0]:
                change[0] = 1 - 2 * there[0]
            if (there > 0).any():
                at = int(np.argmin(change))  # the first of equals, so the smallest gap
                gap, best = at + length, int(change[at])
                change[at] = never
                second = int(change.min())
                n = rest if second == never else max(1, least, (second - best) // 8)
                n = min(n, rest, int(count[gap]))
                count[gap] -= n
                taken = take(runs[gap], n)
            else:
                gap, n = capacity, min(max(1, rest // (capacity // length)), rest if 2 * length > capacity else least)
                taken = [(used, n)]
                used += n
            for first, size in taken:
                rows.append((length, rank, size, first, capacity - gap))
                rank += size
            if gap > length:
                count[gap - length] += n
                runs[gap - length].extend(taken)
            rest -= n
    return rows


def take(runs: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """Remove runs of ``n`` sequences in all from the end of ``runs``."""
    out = []
    while n:
        first, size = runs.pop()
        if size > n:
            runs.append((first + n, size - n))
            size = n
        out.append((first, size))
        n -= size
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, ranks: str = RANKS, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of every piece."""
    cut = stage(pieces(docs, capacity, tokenizer, ranks, with_ids=with_ids), "pieces")
    counts = stage(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = np.array(sorted(plan(histogram, capacity)), np.int64).reshape(-1, 5)
    keys = rows[:, 0] * RANK_SPACE + rows[:, 1]

    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    begins = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("begin"))

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def placed(length: pa.Array, rank: pa.Array) -> pa.Array:
        key = length.to_numpy() * RANK_SPACE + rank.to_numpy()
        at = rows[np.searchsorted(keys, key, side="right") - 1]
        sequence = at[:, 3] + rank.to_numpy() - at[:, 1]
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(at[:, 4])], names=["sequence_id", "offset"])

    ranked = cut.join(begins, ["length", "part"]).withColumn("_place", placed("length", F.col("begin") + F.col("nth")))
    ids = ["ids"] * with_ids
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_place.sequence_id", "_place.offset", *ids)
