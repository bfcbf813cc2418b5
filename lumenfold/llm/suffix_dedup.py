"""Exact substring deduplication with a sampled suffix array.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere is removed. Comparing every
suffix would move the corpus hundreds of times, so suffixes are taken at synchronised places: each
window of LENGTH bytes names the place in it whose next ``GRAM`` bytes have the smallest
hash (the first of equals). The name depends on the window's bytes only, so equal windows name
the same place. Each place stands for a run of windows, and the bytes of that run are its context.

1. Places whose whole contexts are equal (hash of gram and of context, 128 bits) repeat as a
   whole. Places whose gram occurs once do not. Neither needs the text again.
2. The others are suffixes to compare: Spark samples splitters and range-partitions them by their
   leading token, the gram. Equal tokens never part, so no bucket boundary lies between two suffixes
   that could share a window.
3. A bucket sorts its suffixes, to the right and, reversed, to the left of the gram, by multikey
   quicksort: three-way partitions by one word of eight bytes, equals going on to the next word. Common
   prefixes of neighbours then tell for every window length to the left which suffixes share it. This
   goes by portions of whole grams, so that a task's arrays do not grow with its bucket.
4. A gram with more than ``HOT`` places (estimated on a sample of the texts, at most a few hundred
   such grams) is not gathered: its places are dealt by context, and its windows are compared
   one by one through hashes of their bytes, counted before the shuffle.

Texts are handled once per distinct text; a text that occurs twice is removed whole if it has
LENGTH bytes. A null text is an empty one. Rows keep their own line whatever ids repeat;
extra columns are ignored; an empty table gives an empty result. Long texts go through in slices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import digest
from lumenfold.plans.stage import stage

LENGTH = 400
GRAM = 128
SIDE = LENGTH - GRAM
HOT = 100_000
SAMPLE = 0.01
# Lists of hot grams, contexts and texts are broadcast up to so many rows, and joined by shuffle beyond.
LISTED = 100_000
# A worker's arrays stay small: a few times SLICE bytes of text, and so many rows of a table, at once.
SLICE = 1 << 17
TEXTS_AT_ONCE = 256
ROWS_AT_ONCE = 4096
BUCKET_BYTES = 16 << 20
LOCATION = np.dtype([("digest", "S16"), ("pos", "<i8"), ("lo", "<i2"), ("hi", "<i2")])
# Text whose places one task judges: about a million places.
PLACE_BYTES = 128 << 20
PLACE_BITS = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from every position, joined from halves."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    size = 1
    while size < GRAM:
        h = h[:-size] * np.uint64(0x9E3779B97F4A7C15) + (h[size:] ^ (h[size:] >> np.uint64(29)))
        size *= 2
    h ^= h >> np.uint64(31)
    return h * np.uint64(0xD6E8FEB86659FD93)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def places(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place, first window, last window, hash) of the runs of windows inside [begin, end) that name one place."""
    if len(data) < LENGTH:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    hashes = gram_hashes(data)
    marked = (hashes & ~PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    named = (sliding_least(marked, SIDE + 1) & PLACE_BITS).astype(np.int64)
    step = np.zeros(len(named) + 1, np.int32)
    long = ends - begins >= LENGTH
    np.add.at(step, begins[long], 1)
    np.add.at(step, np.minimum(ends[long] - LENGTH + 1, len(named)), -1)
    valid = np.cumsum(step[:-1]) > 0
    opens = valid & np.concatenate([[True], ~valid[:-1] | (named[1:] != named[:-1])])
    opens[begins[long]] = True
    closes = valid & np.concatenate([opens[1:] | ~valid[1:], [True]])
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    return named[first], first, last, hashes[named[first]]


def slices(texts: Iterator[tuple[bytes, bytes]]) -> Iterator[list[tuple[bytes, int, bytes]]]:
    """Groups of (digest, offset, bytes) of about SLICE bytes; slices of one text overlap by all but one byte of a window."""
    group, size = [], 0
    for name, text in texts:
        for at in range(0, max(len(text) - LENGTH + 1, 0), SLICE):
            part = text[at : at + SLICE + LENGTH - 1]
            group.append((name, at, part))
            size += len(part)
            if size >= SLICE:
                yield group
                group, size = [], 0
    if group:
        yield group


def packed(rows: np.ndarray) -> pa.Array:
    """Fixed-width records as an Arrow binary column."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def plain(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The sizes and the joined bytes of a binary column, without an object per value."""
    values = column.combine_chunks()
    _, places, data = values.buffers()
    offsets = np.frombuffer(places, np.int32)[values.offset : values.offset + len(values) + 1]
    joined = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return np.diff(offsets), joined


def unpacked(column: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    return plain(column)[1].view(kind)


def gathered(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All rows of a task as one table, if there are any."""
    held = list(batches)
    return pa.Table.from_batches(held).combine_chunks() if any(b.num_rows for b in held) else None


def few_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            yield batch.slice(at, TEXTS_AT_ONCE)


def find_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, ctx, loc) of every place, once per text and task."""
    seen: set[bytes] = set()

    def texts() -> Iterator[tuple[bytes, bytes]]:
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                if (key := name.as_py()) not in seen:
                    seen.add(key)
                    yield key, text.as_py()

    for group in slices(texts()):
        joined = b"".join(part for _, _, part in group)
        ends = np.cumsum([len(part) for _, _, part in group])
        begins = ends - [len(part) for _, _, part in group]
        place, first, last, gram = places(np.frombuffer(joined, np.uint8), begins, ends)
        owner = np.searchsorted(ends, place, side="right")
        rows = np.zeros(len(place), LOCATION)
        rows["digest"] = np.array([name for name, _, _ in group], "S16")[owner]
        rows["pos"] = place - begins[owner] + np.array([at for _, at, _ in group])[owner]
        rows["lo"], rows["hi"] = place - last, place - first
        view, of = memoryview(joined), xxhash.xxh3_64_intdigest
        seeds = (rows["lo"].astype(np.int64) << 16 | rows["hi"]).tolist()
        spans = zip(first.tolist(), (last + LENGTH).tolist(), seeds, strict=True)
        context = np.fromiter((of(view[a:b], s) for a, b, s in spans), np.uint64, len(place))
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), packed(rows)], names=["gram", "ctx", "loc"]
        )


def judge_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, start, end, gram, pos, lo, hi, hot): spans that repeat as a whole (gram null), and places to compare."""
    if (table := gathered(batches)) is None:
        return
    gram, ctx, hot = (table.column(c).to_numpy() for c in ("gram", "ctx", "hot"))
    loc = unpacked(table.column("loc"), LOCATION)
    order = np.lexsort((ctx, gram))
    gram, ctx, hot, loc = gram[order], ctx[order], hot[order], loc[order]
    new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
    new_ctx = new_gram | np.concatenate([[True], ctx[1:] != ctx[:-1]])
    ctx_run, gram_run = np.cumsum(new_ctx) - 1, np.cumsum(new_gram) - 1
    repeats = (np.bincount(ctx_run)[ctx_run] > 1) | (hot == 2)
    shared = (np.bincount(gram_run, new_ctx)[gram_run] > 1) | (hot > 0)
    for pick, compare in ((repeats, False), (shared & (new_ctx | ~repeats), True)):
        at = np.flatnonzero(pick)
        part = loc[at]
        start, end = part["pos"] - part["hi"], part["pos"] - part["lo"] + LENGTH
        names = ["digest", "start", "end", "gram", "pos", "lo", "hi", "hot"]
        columns = [packed(np.ascontiguousarray(part["digest"])), pa.array(start), pa.array(end)]
        columns.append(pa.array(gram[at]) if compare else pa.nulls(len(at), pa.int64()))
        columns += [pa.array(part["pos"]), pa.array(part["lo"].astype(np.int32)), pa.array(part["hi"].astype(np.int32)), pa.array(hot[at])]
        yield pa.RecordBatch.from_arrays(columns, names=names)


JUDGED = "digest binary, start long, end long, gram long, pos long, lo int, hi int, hot int"


def context_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["gram", "digest", "pos", "lo", "hi", "left", "right"])


def cut_contexts(batches: Iterator[pa.RecordBatch], skip: int = GRAM) -> Iterator[pa.RecordBatch]:
    """The bytes beside each gram that is to be compared: reversed on the left, plain on the right from ``skip`` bytes after its start."""
    unzip, out = zstandard.ZstdDecompressor(), []
    for batch in few_rows(batches):
        for name, packed_text, wanted in zip(*(batch.column(c) for c in ("digest", "ztext", "wanted")), strict=True):
            key, text = name.as_py(), unzip.decompress(packed_text.as_py())
            for w in wanted.as_py():
                p, lo, hi = w["pos"], w["lo"], w["hi"]
                out.append((w["gram"], key, p, lo, hi, text[p - hi : p][::-1], text[p + skip : p - lo + LENGTH]))
                if len(out) == ROWS_AT_ONCE:
                    yield context_batch(out)
                    out = []
    if out:
        yield context_batch(out)


CONTEXTS = "gram long, digest binary, pos long, lo int, hi int, left binary, right binary"


def byte_matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Byte strings as rows filled with zeros; a width that is a multiple of eight."""
    size, joined = plain(column)
    out = np.zeros((len(size), width + -width % 8), np.uint8)
    out[np.arange(out.shape[1]) < size[:, None]] = joined
    return out


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """The order of the rows of a matrix of words.

    All open segments take a step together: the word at the depth of a segment is compared with that of
    its middle row, smaller, equal and larger rows become segments of their own, and
    the equal ones go one word deeper.
    """
    n, depth_end = words.shape
    order, segment = np.arange(n), np.zeros(n, np.int64)
    depth = np.zeros(1, np.int64)
    at = np.arange(n)  # positions whose segment is open
    while len(at):
        seg = segment[at]
        new = np.concatenate([[True], seg[1:] != seg[:-1]])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(at)))
        run = np.cumsum(new) - 1
        level = depth[seg[starts]]
        value = words[order[at], level[run]]
        pivot = value[starts + sizes // 2][run]
        side = (value > pivot).astype(np.int64) + (value >= pivot)
        moved = np.argsort(run * 3 + side, kind="stable")
        order[at] = order[at][moved]
        part = (run * 3 + side)[moved]
        fresh = np.concatenate([[True], part[1:] != part[:-1]])
        number = np.cumsum(fresh) - 1 + len(depth)
        firsts = np.flatnonzero(fresh)
        depth = np.concatenate([depth, level[part[firsts] // 3] + (part[firsts] % 3 == 1)])
        segment[at] = number
        lengths = np.diff(np.append(firsts, len(at)))
        open_part = (lengths > 1) & (depth[number[firsts]] < depth_end)
        at = at[np.repeat(open_part, lengths)]
    return order


def common_prefix(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Equal leading bytes of each row and the next in this order."""
    out = np.zeros(max(len(order) - 1, 0), np.int64)
    for at in range(0, len(out), ROWS_AT_ONCE):
        some = rows[order[at : at + ROWS_AT_ONCE + 1]]
        differ = some[1:] != some[:-1]
        out[at : at + ROWS_AT_ONCE] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def sorted_side(rows: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each suffix by gram and row, and the common prefixes along the ranks (-1 between grams)."""
    words = np.empty((len(rows), 1 + rows.shape[1] // 8), np.uint64)
    words[:, 0], words[:, 1:] = gram.view(np.uint64), rows.view(">u8")
    order = multikey_quicksort(words)
    common = common_prefix(rows, order)
    common[gram[order][1:] != gram[order][:-1]] = -1
    return np.argsort(order), common


def shared_windows(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For every suffix and number of bytes to the left: whether another suffix has the same window."""
    (left_rank, left_common), (right_rank, right_common), n = left, right, len(lo)
    found = np.zeros((n, SIDE + 1), bool)
    for d in range(SIDE + 1):
        at = np.flatnonzero((lo <= d) & (d <= hi))
        if len(at) < 2:
            continue
        right_class = np.concatenate([[0], np.cumsum(right_common < SIDE - d)])[right_rank[at]]
        left_class = np.concatenate([[0], np.cumsum(left_common < d)])[left_rank[at]]
        both = right_class * n + left_class
        order = np.argsort(both)
        same = both[order][1:] == both[order][:-1]
        found[at[order], d] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    return found


def whole_grams(gram: np.ndarray) -> Iterator[np.ndarray]:
    """The rows by gram in portions of about ROWS_AT_ONCE that part no gram."""
    order = np.argsort(gram, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], gram[order][1:] != gram[order][:-1]]))
    portion = starts // ROWS_AT_ONCE
    cuts = starts[np.concatenate([[True], portion[1:] != portion[:-1]])]
    yield from np.split(order, cuts[1:])


def sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, start, end) of the windows that two suffixes of the bucket share."""
    if (table := gathered(batches)) is None:
        return
    for some in whole_grams(table.column("gram").to_numpy()):
        part = table.take(pa.array(some))
        gram, pos, lo, hi = (part.column(c).to_numpy() for c in ("gram", "pos", "lo", "hi"))
        left = sorted_side(byte_matrix(part.column("left"), SIDE), gram)
        right = sorted_side(byte_matrix(part.column("right"), SIDE), gram)
        found = shared_windows(left, right, lo, hi)
        for at in range(0, len(found), ROWS_AT_ONCE):
            edge = np.diff(np.pad(found[at : at + ROWS_AT_ONCE].astype(np.int8), ((0, 0), (1, 1))), axis=1)
            (row, first), (_, past) = np.nonzero(edge == 1), np.nonzero(edge == -1)
            row += at
            names = part.column("digest").combine_chunks().take(pa.array(row))
            start, end = pos[row] - past + 1, pos[row] - first + LENGTH
            yield pa.RecordBatch.from_arrays([names, pa.array(start), pa.array(end)], names=["digest", "start", "end"])


def window_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.binary(), pa.int64()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["window", "digest", "start"])


def single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, digest, start): a 128-bit hash of every window of the places of hot grams, cut in the same worker."""
    out = []
    for batch in cut_contexts(batches, skip=0):
        for name, pos, lo, hi, left, right in zip(*(batch.column(c).to_pylist() for c in ("digest", "pos", "lo", "hi", "left", "right")), strict=True):
            whole = left[::-1] + right
            for d in range(lo, hi + 1):
                out.append((xxhash.xxh3_128_digest(whole[hi - d : hi - d + LENGTH]), name, pos - d))
            if len(out) >= ROWS_AT_ONCE:
                yield window_batch(out)
                out = []
    if out:
        yield window_batch(out)


def remove_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, n_bytes, n_removed, n_spans, kept_sha256, spans) of every distinct text."""
    unzip = zstandard.ZstdDecompressor()
    for batch in few_rows(batches):
        out = []
        for name, ztext, copies, found in zip(*(batch.column(c).to_pylist() for c in ("digest", "ztext", "copies", "found")), strict=True):
            text = unzip.decompress(ztext)
            runs = [(0, len(text))] if copies > 1 and len(text) >= LENGTH else merge(found or [])
            kept, at = hashlib.sha256(), 0
            for a, b in runs:
                kept.update(text[at:a])
                at = b
            kept.update(text[at:])
            out.append((name, len(text), sum(b - a for a, b in runs), len(runs), kept.hexdigest(), [{"start": a, "end": b} for a, b in runs]))
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), spans]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds],
            names=["digest", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def merge(found: list[dict]) -> list[tuple[int, int]]:
    """Spans that touch or overlap, joined."""
    runs: list[list[int]] = []
    for a, b in sorted((f["start"], f["end"]) for f in found):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return [(a, b) for a, b in runs]


def zip_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, ztext): texts compressed for the shuffle, once per text and task."""
    squeeze, seen = zstandard.ZstdCompressor(level=3), set()
    for batch in few_rows(batches):
        rows = []
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if name not in seen:
                seen.add(name)
                rows.append((name, squeeze.compress(text.as_py())))
        names, texts = zip(*rows, strict=True) if rows else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(texts, pa.binary())], names=["digest", "ztext"])


def named_texts(docs: DataFrame, text: str) -> DataFrame:
    """(digest, text as bytes)."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(digest(whole).alias("digest"), whole.cast("binary").alias("text"))


def with_heat(found: DataFrame, docs: DataFrame, text: str, hot: int, sample: float) -> DataFrame:
    """Add ``hot``: 1 for places of a gram with more than ``hot`` places by a sample, 2 if the context is so frequent."""
    some = named_texts(docs.sample(sample, seed=1), text).mapInArrow(find_places, "gram long, ctx long, loc binary")
    seen = stage(some.select("gram", "ctx"), "sampled-places")
    most = max(2, int(hot * sample))
    grams = seen.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > most)
    grams = stage(grams.select("gram", F.lit(1).alias("hot_gram")), "hot-grams")
    contexts = seen.join(F.broadcast(grams) if (n := grams.count()) <= LISTED else grams, "gram", "left_semi")
    contexts = contexts.groupBy("gram", "ctx").agg(F.count("*").alias("n")).where(F.col("n") > most)
    contexts = stage(contexts.select("gram", "ctx", F.lit(2).alias("hot_ctx")), "hot-contexts")
    if not n:
        return found.withColumn("hot", F.lit(0))
    near = F.broadcast if n <= LISTED and contexts.count() <= LISTED else lambda df: df
    both = found.join(near(grams), "gram", "left").join(near(contexts), ["gram", "ctx"], "left")
    return both.withColumn("hot", F.coalesce("hot_ctx", "hot_gram", F.lit(0))).drop("hot_ctx", "hot_gram")


def place_partitions(texts: DataFrame) -> int:
    """How many tasks judge the places: one for ``PLACE_BYTES`` of text, and no fewer than the session's usual number."""
    size = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()["bytes"] or 0
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PLACE_BYTES))


def repeats(docs: DataFrame, text: str = "text", hot: int = HOT, sample: float = SAMPLE) -> DataFrame:
    """(digest, n_bytes, n_removed, n_spans, kept_sha256, spans) per distinct text."""
    texts = named_texts(docs, text)
    found = texts.mapInArrow(find_places, "gram long, ctx long, loc binary")
    heated = with_heat(found, docs, text, hot, sample)
    dealt = F.when(F.col("hot") > 0, F.col("ctx")).otherwise(0), F.when(F.col("hot") > 1, F.xxhash64("loc")).otherwise(0)
    parts = place_partitions(texts)
    judged = stage(heated.repartition(parts, "gram", *dealt).mapInArrow(judge_places, JUDGED), "judged-places")

    def zipped(some: DataFrame) -> DataFrame:
        return some.mapInArrow(zip_texts, "digest binary, ztext binary").dropDuplicates(["digest"])

    once = zipped(texts)
    wanted = judged.where("gram IS NOT NULL")

    def with_lists(once: DataFrame, some: DataFrame) -> DataFrame:
        lists = some.groupBy("digest").agg(F.collect_list(F.struct("gram", "pos", "lo", "hi")).alias("wanted"))
        return once.join(lists, "digest").select("digest", "ztext", "wanted")

    size = wanted.agg(F.sum(F.col("hi") - F.col("lo") + SIDE).alias("bytes"), F.count(F.when(F.col("hot") > 0, 1)).alias("hot")).first()
    buckets = max(1, -(-(size["bytes"] or 0) // BUCKET_BYTES))
    ranged = with_lists(once, wanted.where("hot = 0")).mapInArrow(cut_contexts, CONTEXTS).repartitionByRange(buckets, "gram")
    spans = judged.where("gram IS NULL").select("digest", "start", "end")
    spans = spans.unionAll(ranged.mapInArrow(sort_bucket, "digest binary, start long, end long"))
    if size["hot"]:
        hot_wanted = wanted.where("hot > 0")
        few = size["hot"] <= LISTED  # then only the texts with such places are compressed and sent
        hot_texts = texts.join(F.broadcast(hot_wanted.select("digest").distinct()), "digest", "left_semi") if few else texts
        hot_places = with_lists(zipped(hot_texts), hot_wanted)
        single = stage(hot_places.mapInArrow(single_windows, "window binary, digest binary, start long"), "hot-windows")
        twice = single.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
        again = single.join(twice, "window").select("digest", "start", (F.col("start") + LENGTH).alias("end"))
        spans = spans.unionAll(again)
    listed = spans.groupBy("digest").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    copies = texts.groupBy("digest").agg(F.count("*").alias("copies"))
    ready = once.join(listed, "digest", "left").join(copies, "digest").select("digest", "ztext", "copies", "found")
    schema = "digest binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    return ready.mapInArrow(remove_spans, schema)


def deduplicate(docs: DataFrame, hot: int = HOT, sample: float = SAMPLE) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, has_repeats (some bytes were removed)."""
    found = repeats(docs, "text", hot, sample).drop("spans")
    rows = docs.select("doc_id", digest(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("digest"))
    has_repeats = (F.col("n_removed") > 0).alias("has_repeats")
    return rows.join(found, "digest").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", has_repeats)
