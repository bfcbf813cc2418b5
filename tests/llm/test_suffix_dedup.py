import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from lumenfold.llm import suffix_dedup
from tests.llm.conftest import LONG, make


def brute(texts):
    """By definition: bytes covered by a window that starts at two places of the corpus."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for b in data:
        for i in range(len(b) - suffix_dedup.LENGTH + 1):
            w = b[i : i + suffix_dedup.LENGTH]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - suffix_dedup.LENGTH + 1):
            if seen[b[i : i + suffix_dedup.LENGTH]] > 1:
                gone[i : i + suffix_dedup.LENGTH] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def texts_with_repeats(seed, n=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(7))
    passages = ["".join(word() for _ in range(rng.choice([40, 58, 60, 80, 150]))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages)[rng.randrange(30) :] if rng.random() < 0.5 else "".join(word() for _ in range(50)) for _ in range(4)]
        texts.append("".join(parts))
    return [*texts, texts[0], texts[1][:700], texts[2].replace("a", "b", 1), "ab" * 600, "a" * 900, None, "", "a" * 399, "a" * 400]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_equals_brute_force(spark, hot):
    texts = texts_with_repeats(7)
    rows = suffix_dedup.deduplicate(make(spark, texts), hot=hot, sample=1.0 if hot == 2 else 0.01).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert got == dict(enumerate(brute(texts)))


@pytest.mark.parametrize("listed", [suffix_dedup.LISTED, 0])
def test_hot_grams_take_only_their_texts(spark, monkeypatch, listed):
    """The texts with places of hot grams are picked by a broadcast list, or by the join if there are too many."""
    monkeypatch.setattr(suffix_dedup, "LISTED", listed)
    sent = []
    plain = suffix_dedup.stage
    monkeypatch.setattr(suffix_dedup, "stage", lambda df, name: plain(sent.append((name, df)) or df, name))
    rng = random.Random(4)
    passage, filler = ("".join(rng.choices("abcdefgh ", k=k)) for k in (600, 40_000))
    texts = [filler[i * 500 : i * 500 + 50] + passage + filler[i * 500 + 50 : i * 500 + 200] for i in range(20)]
    texts += [filler[10_000 + i * 500 : 10_500 + i * 500] for i in range(40)]
    rows = suffix_dedup.deduplicate(make(spark, texts), hot=5, sample=1.0).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert got == dict(enumerate(brute(texts)))
    plan = next(df for name, df in sent if name == "hot-windows")._jdf.queryExecution().optimizedPlan().toString()
    assert ("LeftSemi" in plan) == (listed > 0)
    assert plan.count("MapInArrow") == 2  # zip_texts and single_windows


def test_long_texts_in_slices(spark, monkeypatch):
    texts = texts_with_repeats(8, 12)
    found = [list(suffix_dedup.slices(iter([(b"x" * 16, t.encode())]))) for t in texts if t]
    assert sum(map(len, found)) >= 12
    data = "".join(t or "" for t in texts).encode()
    whole = next(suffix_dedup.slices(iter([(b"x", data)])))
    monkeypatch.setattr(suffix_dedup, "SLICE", 1000)
    parts = [p for g in suffix_dedup.slices(iter([(b"x", data)])) for p in g]
    assert len(parts) > 3 and len(whole) == 1
    assert {i + at for _, at, p in parts for i in range(len(p) - 399)} == set(range(len(data) - 399))


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, (500, 6)).astype(np.uint64)
    order = suffix_dedup.multikey_quicksort(words)
    assert [tuple(words[i]) for i in order] == sorted(map(tuple, words))


def bucket(n):
    """Suffixes of n // 4 grams, each beside one of two random texts on either side."""
    rng = np.random.default_rng(3)
    side = [rng.bytes(suffix_dedup.SIDE) for _ in range(n // 2)]
    gram = rng.integers(0, n // 4, n)
    hi = rng.integers(0, suffix_dedup.SIDE + 1, n)
    lo = rng.integers(0, hi + 1)
    left = [side[2 * g + v][:h] for g, v, h in zip(gram, rng.integers(0, 2, n), hi, strict=True)]
    right = [side[2 * g + v][: suffix_dedup.SIDE - k] for g, v, k in zip(gram, rng.integers(0, 2, n), lo, strict=True)]
    names = pa.array([b"%016d" % i for i in range(n)])
    columns = [pa.array(gram), names, pa.array(np.full(n, 1000)), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(left), pa.array(right)]
    return pa.RecordBatch.from_arrays(columns, names=["gram", "digest", "pos", "lo", "hi", "left", "right"])


def spans_of(batches):
    return sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))


def test_a_bucket_in_portions(monkeypatch):
    """A bucket's arrays are a portion's, not the bucket's; portions part no gram and lose no window."""
    rows = bucket(24_000)
    tracemalloc.start()
    for _ in suffix_dedup.sort_bucket(iter([rows])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * rows.nbytes
    some = bucket(400)
    want = set()
    for r in (found := some.to_pylist()):
        for d in range(r["lo"], r["hi"] + 1):
            window = lambda x, d=d: (x["gram"], x["left"][:d], x["right"][: suffix_dedup.SIDE - d])
            if any(x is not r and x["gram"] == r["gram"] and x["lo"] <= d <= x["hi"] and window(x) == window(r) for x in found):
                want.add((r["digest"], 1000 - d))
    for portion in (suffix_dedup.ROWS_AT_ONCE, 3):
        monkeypatch.setattr(suffix_dedup, "ROWS_AT_ONCE", portion)
        got = spans_of(suffix_dedup.sort_bucket(iter([some])))
        assert {(name, a) for name, start, end in got for a in range(start, end - suffix_dedup.LENGTH + 1)} == want and want


def test_contexts_and_windows_in_portions():
    """Long texts with many places give batches of few rows, and the windows of hot grams need one worker only."""
    rng = np.random.default_rng(5)
    texts = [rng.bytes(20_000) for _ in range(12)]
    places = [{"gram": 1, "pos": p, "lo": 0, "hi": 9} for p in range(100, 19_000, 20)]
    squeeze = zstandard.ZstdCompressor()
    columns = [pa.array([b"%016d" % i for i in range(12)]), pa.array([squeeze.compress(t) for t in texts]), pa.array([places] * 12)]
    rows = pa.RecordBatch.from_arrays(columns, names=["digest", "ztext", "wanted"])
    cut = list(suffix_dedup.cut_contexts(iter([rows])))
    assert sum(b.num_rows for b in cut) == 12 * len(places) and max(b.num_rows for b in cut) <= suffix_dedup.ROWS_AT_ONCE
    single = list(suffix_dedup.single_windows(iter([rows])))
    assert sum(b.num_rows for b in single) == 120 * len(places) and max(b.num_rows for b in single) <= suffix_dedup.ROWS_AT_ONCE + suffix_dedup.SIDE
    assert len(set().union(*(b.column("window").to_pylist() for b in single))) == 12 * (18_900 // 20) * 10


def test_odd_rows(spark, odd, none):
    rows = suffix_dedup.deduplicate(odd).collect()
    assert len(rows) == 12
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["n_bytes"] == 0 and by_id[0]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by_id[5]["n_removed"] == by_id[6]["n_removed"] == len(LONG)
    assert by_id[8]["n_removed"] == 1000 and by_id[9]["n_removed"] == 150_000 and by_id[3]["n_removed"] == 0
    assert suffix_dedup.deduplicate(none).count() == 0


def window_sums(data, base):
    """A polynomial hash of every window of LENGTH bytes, from running sums modulo 2^64."""
    n = suffix_dedup.LENGTH
    if len(data) < n:
        return np.zeros(0, np.uint64)
    power = np.full(len(data), base, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(7)) * power)])
    back = np.full(len(data), pow(base, -1, 1 << 64), np.uint64)
    back[0] = 1
    return (sums[n:] - sums[:-n]) * np.cumprod(back)[: len(data) - n + 1]


def test_a_whole_table_equals_brute_force(spark):
    """All documents of a data folder against hashes of all their windows."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    data = [np.frombuffer(t, np.uint8) for _, t in texts]
    parts = [[window_sums(d, b) for d in data] for b in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]
    both = np.concatenate(parts[0]) ^ (np.concatenate(parts[1]) * np.uint64(0xFF51AFD7ED558CCD))
    _, place, n = np.unique(both, return_inverse=True, return_counts=True)
    again = n[place] > 1
    want, at = {}, 0
    for (doc, text), d in zip(texts, data, strict=True):
        size = max(0, len(d) - suffix_dedup.LENGTH + 1)
        edges = np.zeros(len(d) + 1, np.int64)
        hits = np.flatnonzero(again[at : at + size])
        np.add.at(edges, hits, 1)
        np.add.at(edges, hits + suffix_dedup.LENGTH, -1)
        at += size
        gone = np.cumsum(edges)[:-1] > 0
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[doc] = (len(text), int(gone.sum()), runs, hashlib.sha256(d[~gone].tobytes()).hexdigest(), bool(gone.any()))
    rows = suffix_dedup.deduplicate(docs).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], r["has_repeats"]) for r in rows}
    assert len(rows) == len(texts) and got == want
