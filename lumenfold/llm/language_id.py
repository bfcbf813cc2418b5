"""Language identification with a string kernel.

A text is the set of its n-grams of 1 to ``LONGEST`` characters (blended spectrum, presence
only), over its letters in lower case with one blank between words. The kernel of two texts is
the number of n-grams that both have, divided by the root of the product of their numbers.
N-grams are hashed to ``WIDTH`` places. A bounded sample of labelled texts is mapped to its kernels
with ``LANDMARKS`` landmark texts (Nyström); kernel ridge regression of every language against
the rest is solved in that space. Texts are scored in batches: presence matrix times
landmark matrix, scaled, times the coefficients.

Fit on at most ``SAMPLE`` labelled rows, an equal share per language, chosen by a hash. Only their
text and language are used, and only rows outside the held-out quarter (crc32 of the id as text,
modulo 4, is 2). Every row is classified by its whole text.

Null texts and texts without a letter are ``und`` with score 0, as is every text if nothing can be
learned. Rows without an id are not held out and not learned from. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONGEST = 4
WIDTH = 1 << 14
LANDMARKS = 128
SAMPLE = 2_000
RIDGE = 1e-3
BATCH = 128
SPACE = 32
UNKNOWN = "und"


@cache
def letter_table() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def presence(text: str | None, into: np.ndarray) -> bool:
    """Mark the places of the n-grams of ``text`` in ``into``; False if it has no letter."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letter_table()[points]
    if not letter.any():
        return False
    kept = letter | np.concatenate([[True], letter[:-1]])
    chars = np.where(letter, points, SPACE)[kept].astype(np.uint32)
    code = np.zeros(len(chars), np.uint32)
    for n in range(1, LONGEST + 1):
        if len(chars) < n:
            break
        code = code[: len(chars) - n + 1] * np.uint32(0x01000193) + chars[n - 1 :] + np.uint32(n)
        into[(code * np.uint32(0x9E3779B1)) >> np.uint32(32 - WIDTH.bit_length() + 1)] = True
    return True


def present(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(presence matrix, whether each text has letters)."""
    marks = np.zeros((len(texts), WIDTH), bool)
    return marks, np.array([presence(t, m) for t, m in zip(texts, marks, strict=True)], bool)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    landmarks: np.ndarray  # packed bits
    coefficients: np.ndarray

    def classify(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        marks, known = present(texts)
        scores = kernel(marks, self.spread()) @ self.coefficients
        best = scores.argmax(axis=1)
        sure = np.clip((scores[np.arange(len(best)), best] + 1) / 2, 0, 1)
        return (
            [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)],
            [float(s) if k else 0.0 for s, k in zip(sure, known, strict=True)],
        )

    def spread(self) -> np.ndarray:
        return np.unpackbits(self.landmarks, axis=1).astype(np.float32)


def kernel(marks: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Shared n-grams of every text and landmark, over the root of the product of their numbers."""
    sizes = np.maximum(marks.sum(axis=1, dtype=np.float32), 1)[:, None] * np.maximum(landmarks.sum(axis=1), 1)[None, :]
    return (marks.astype(np.float32) @ landmarks.T) / np.sqrt(sizes)


def held_out(doc: Column) -> Column:
    return F.coalesce(F.crc32(doc.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """A model from a sample of the labelled rows. The driver sees the packed presence bits of the sample."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], np.zeros((0, WIDTH // 8), np.uint8), np.zeros((0, 0)))
    each = max(1, sample // len(counts))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, int(min(1.0, each / n) * (1 << 30)))])

    @F.arrow_udf("binary")
    def bits(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            marks, known = present([text.as_py()])
            out.append(np.packbits(marks[0]).tobytes() if known[0] else None)
        return pa.array(out, pa.binary())

    chosen = usable.where(place < share[F.col("lang")]).limit(2 * sample)
    rows = chosen.select("lang", bits(F.col("text").cast("string")).alias("bits")).where("bits IS NOT NULL").toArrow()
    lang = np.array(rows.column("lang").to_pylist())
    if not len(lang):
        return Model([], np.zeros((0, WIDTH // 8), np.uint8), np.zeros((0, 0)))
    packed = np.stack([np.frombuffer(b, np.uint8) for b in rows.column("bits").to_pylist()])
    order = np.lexsort((packed[:, :64].sum(axis=1), lang))
    lang, packed = lang[order], packed[order]
    languages = sorted(set(lang))
    per = max(1, landmarks // len(languages))
    picked = np.concatenate([np.flatnonzero(lang == x)[np.linspace(0, (lang == x).sum() - 1, min(per, (lang == x).sum())).astype(int)] for x in languages])
    marks = np.unpackbits(packed[picked], axis=1).astype(np.float32)
    among = kernel(marks, marks).astype(float)
    values, vectors = np.linalg.eigh(among)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    mapped = np.concatenate([kernel(np.unpackbits(packed[i : i + 256], axis=1), marks) for i in range(0, len(packed), 256)]) @ root
    targets = np.where(lang[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # Languages weigh the same however many rows they have.
    weight = (len(lang) / len(languages) / np.array([(lang == x).sum() for x in lang]))[:, None]
    left = mapped.T @ (weight * mapped) + ridge * len(lang) * np.eye(mapped.shape[1])
    solved = np.linalg.solve(left, mapped.T @ (weight * targets))
    return Model([str(x) for x in languages], packed[picked], (root @ solved).astype(np.float32))


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document row: doc_id, held_out, lang_pred, score."""
    model = model or fit(docs)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def classified(texts: pa.Array) -> pa.Array:
        langs, scores = [], []
        for at in range(0, len(texts), BATCH):
            a, b = model.classify(texts.slice(at, BATCH).to_pylist())
            langs += a
            scores += b
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    rows = docs.select("doc_id", classified(F.col("text").cast("string")).alias("_found"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "_found.lang_pred", "_found.score")
