import random

import pytest
import xxhash

from lumenfold.llm import simhash
from tests.llm.conftest import PASSAGE, make


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.encode().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """(smallest index reachable) over all pairs at two or fewer bits."""
    group = list(range(len(prints)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                x, y = sorted((find(i), find(j)))
                group[y] = x
    return [find(i) for i in range(len(prints))]


def near_texts(n=60):
    rng = random.Random(5)
    words = PASSAGE.split() * 8
    texts = []
    for _ in range(n):
        some = list(words)
        for _ in range(rng.randrange(4)):
            some[rng.randrange(len(some))] = rng.choice(["Zebra", "yak", "ÄPFEL", "x y"])
        texts.append(" ".join(some))
    return [*texts, texts[0].upper(), None, "", " \x0b\x0c", "one", "one two", "One\ttwo", "one two three", "ß ß a b c"]


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_equals_brute_force(spark, bucket):
    texts = near_texts()
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(make(spark, texts), bucket=bucket).collect()}
    prints = [brute_fingerprint(t) for t in texts]
    assert [rows[i]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [rows[i]["component_id"] for i in range(len(texts))] == brute_components(prints)


@pytest.mark.parametrize("bucket", [64, 3])
def test_links_of_planted_fingerprints(spark, bucket):
    rng = random.Random(9)
    prints = [0, (1 << 64) - 1]
    for _ in range(12):
        p = rng.getrandbits(64)
        for _ in range(10):
            prints.append(p)
            for _ in range(rng.randrange(1, 4)):
                p ^= 1 << rng.randrange(64)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(signed)], "doc long, fp long")
    got = {r["fp"]: r["component_id"] for r in simhash.classes(rows, bucket).collect()}
    assert [got[s] for s in signed] == brute_components(prints)


def test_keep_one(spark, odd, none):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    texts = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in kept.collect())
    assert texts == [-1, 0, 3, 5, 8, 9, 11]
    assert simhash.keep_one(none).count() == 0 and simhash.near_duplicates(none).count() == 0
    same = simhash.near_duplicates(odd).where("doc_id IN (0, 1, 2)").select("fingerprint", "component_id").distinct().collect()
    assert [tuple(r) for r in same] == [("0" * 16, 0)]


@pytest.mark.parametrize("crowds", [simhash.CROWDS, 0])
def test_no_table_that_grows_with_the_documents_is_broadcast(spark, monkeypatch, crowds):
    """Spark's own sizes are too low after an explode, so even small tables show whether it is left to choose."""
    plans, write = [], simhash.stage

    def watched(df, name):
        plans.append(df._jdf.queryExecution().toString())
        return write(df, name)

    monkeypatch.setattr(simhash, "stage", watched)
    monkeypatch.setattr(simhash, "CROWDS", crowds)
    found = simhash.near_duplicates(make(spark, near_texts()))
    plans.append(found._jdf.queryExecution().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 4 and not [p for p in plans if "BroadcastExchange" in p]
    few = simhash.near_duplicates(make(spark, near_texts()), bucket=2)
    assert sorted(few.collect()) == sorted(found.collect())
    assert any("BroadcastExchange" in p for p in plans) == (crowds > 0)
