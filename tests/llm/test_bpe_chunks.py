import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lumenfold.llm import bpe_chunks
from tests.llm.conftest import LONG, make

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "b", "the", "'s", "'ll", " ", "  ", "\n", "\t", "é", "é", "́", "İ", "Σ", "日", "1", "99", "<|endoftext|>", "<|start", "oftext|>"]
PIECES += ["!", "...", "\xa0", "\x85", "x" * 30, "‍", "👍🏽", "ﬁ", "\r\n", "가", "ᄀ", "ᅡ", " "]


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(PATH)


def brute(model, text):
    ids = model.encode(text or "", add_special_tokens=False).ids
    decoded = model.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def small_chunks(monkeypatch):
    for name, value in (("LEAST", 4), ("MEAN", 8), ("MOST", 40)):
        monkeypatch.setattr(bpe_chunks, name, value)


def test_any_cut_is_repaired(model, monkeypatch):
    small_chunks(monkeypatch)
    with open(PATH) as file:
        codec = bpe_chunks.Codec(file.read())
    rng, cut = random.Random(3), 0
    for _ in range(1500):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(120)))
        want = model.encode(text, add_special_tokens=False).ids
        starts = bpe_chunks.chunk_starts(bpe_chunks.code_points(text))
        cut += len(starts) - 1
        bounds = [*starts, len(text)]
        some = [k for k in range(len(starts)) if rng.random() < 0.5]
        given = dict(zip(some, codec.encode([text[bounds[k] : bounds[k + 1]] for k in some]), strict=True))
        assert bpe_chunks.encode_text(text, codec, given).tolist() == want
        assert codec.decode(np.array(want, int)) == model.decode(want, skip_special_tokens=False)
    assert cut > 5000


def test_wrong_chunk_tokens_widen_the_window(model, monkeypatch):
    """Tokens that do not agree around a join are replaced, as far as the disagreement goes."""
    small_chunks(monkeypatch)
    with open(PATH) as file:
        codec = bpe_chunks.Codec(file.read())
    text = " ".join(f"word{k} and" for k in range(60))
    starts = bpe_chunks.chunk_starts(bpe_chunks.code_points(text))
    bounds = [*starts, len(text)]
    given = {}
    for k in range(len(starts)):
        ids, places = codec.encode([text[bounds[k] : bounds[k + 1]]])[0]
        given[k] = (np.where(np.arange(len(ids)) % 7 == 6, 5, ids).astype(np.uint32), places)
    got = bpe_chunks.encode_text(text, codec, given).tolist()
    assert sum(a != b for a, b in zip(got, codec.encode([text])[0][0].tolist(), strict=True)) < sum((g[0] == 5).sum() for g in given.values())


def test_equal_passages_fall_into_equal_chunks():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(6000)]
    passage = " ".join(words[:4000])
    cuts = []
    for head in ("", "x" * 777, " ".join(words[5000:])):
        text = head + passage
        bounds = [*bpe_chunks.chunk_starts(bpe_chunks.code_points(text)), len(text)]
        cuts.append({text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)})
    assert len(cuts[0] & cuts[1] & cuts[2]) >= len(cuts[0]) - 2
    assert all(len(c) <= bpe_chunks.MOST for c in cuts[2])


def test_blocks_of_a_long_text_do_not_move_cuts(monkeypatch):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ") for _ in range(50_000))
    points = bpe_chunks.code_points(text)
    want = bpe_chunks.candidates(points).tolist()
    monkeypatch.setattr(bpe_chunks, "BLOCK", 1000)
    assert bpe_chunks.candidates(points).tolist() == want


def test_whole_texts_with_shared_passages(spark, model, odd):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(9000)]
    shared = " ".join(words[:3000])
    texts = [" ".join(rng.sample(words, 300)) + shared + " ".join(rng.sample(words, 300)) for _ in range(20)]
    texts += [texts[0]] * 5 + [shared + shared, "x" * 70_000, "a b " * 20_000, "日本語" * 9000]
    docs = make(spark, texts, range(100, 100 + len(texts))).unionByName(odd)
    want = sorted((str(r["doc_id"]), *brute(model, r["text"])) for r in docs.collect())
    got = bpe_chunks.encode(docs, PATH, bpe_chunks.digests()).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want


def test_a_shared_chunk_is_encoded_once(spark):
    rng = random.Random(10)
    shared = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4000))
    docs = make(spark, [f"{k} {shared}" for k in range(8)])
    rows = bpe_chunks.chunk_rows(docs)
    shared_rows = rows.groupBy("chunk").count().where("count > 1")
    assert shared_rows.count() >= 5 and shared_rows.agg({"count": "min"}).first()[0] == 8


def test_ids_and_text_without_derived_columns(spark, model):
    row = bpe_chunks.encode(make(spark, [LONG]), PATH).first()
    assert np.frombuffer(row["ids"], "<u4").tolist() == model.encode(LONG, add_special_tokens=False).ids
    assert row["decoded"] == model.decode(np.frombuffer(row["ids"], "<u4").tolist(), skip_special_tokens=False)


def test_empty_table(spark, none):
    assert bpe_chunks.encode(none, PATH, bpe_chunks.digests()).collect() == []
