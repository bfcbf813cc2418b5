import hashlib
import random
import re

from lumenfold.llm import decontaminate
from tests.llm.conftest import PASSAGE, make

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add("" if item is None else str(item))
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        names = ",".join(sorted(found)).encode()
        out.append((len(w), len(hit), len(found), hashlib.sha256(names).hexdigest(), bool(hit)))
    return out


def sample():
    rng = random.Random(2)
    vocabulary = ["the", "of", "a", "Zürich", "día", "x1", "run", "sky", "İx", "no"]
    text = lambda n: rng.choice([" ", ", ", "\n", "_"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(14)) for i in range(12)] + [(100, "the of"), (101, PASSAGE), (2, "sky sky sky"), (None, text(11)), (7, None), (8, "?!")]
    texts = [text(60) for _ in range(25)]
    texts += [text(20) + " " + items[i][1] + " " + text(8) for i in range(6)]
    texts += [PASSAGE.upper(), PASSAGE[:60], PASSAGE * 3, None, "", "the", "sky sky sky sky", "a " * 3000, PASSAGE.replace("the", "thé")]
    return texts + texts[:3], items


def frames(spark):
    texts, items = sample()
    return make(spark, texts), spark.createDataFrame([(i, t, "d") for i, t in items], "item_id long, text string, digest string")


def check(spark):
    texts, items = sample()
    docs, table = frames(spark)
    rows = {r["doc_id"]: r for r in decontaminate.document_hits(docs, table).collect()}
    got = [(r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in (rows[i] for i in range(len(texts)))]
    assert got == brute(texts, items)


def test_equals_brute_force(spark):
    check(spark)


def test_terms_in_blocks(spark, monkeypatch):
    blocks = decontaminate.byte_blocks
    monkeypatch.setattr(decontaminate, "byte_blocks", lambda df, c: blocks(df, c, 300))
    check(spark)


def test_proximity(spark):
    others = "alpha beta gamma delta epsilon zeta eta theta"
    items = spark.createDataFrame([(1, others + " iota kappa")], "item_id long, text string")
    docs = make(spark, [others + " iota kappa", "iota x kappa", others, others + " " + others, "iota " + "x " * 9 + "kappa", others])
    rows = {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in decontaminate.document_hits(docs, items).collect()}
    assert rows == {0: (10, 0), 1: (0, 1), 2: (0, 0), 3: (0, 0), 4: (0, 0), 5: (0, 0)}


def test_drop_contaminated(spark, odd, none):
    texts, items = sample()
    docs, table = frames(spark)
    kept = decontaminate.drop_contaminated(docs, table)
    assert kept.columns == docs.columns
    clean = [i for i, b in enumerate(brute(texts, items)) if not b[4]]
    assert sorted(r["doc_id"] for r in kept.collect()) == clean
    assert decontaminate.document_hits(odd, table).count() == 12
    assert decontaminate.document_hits(none, table).count() == 0
    assert decontaminate.drop_contaminated(odd, table.limit(0)).count() == 12
