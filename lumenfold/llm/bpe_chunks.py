"""BPE encoding and decoding that encodes chunks shared by several texts once.

A rolling hash over a window of characters cuts every text where the hash has a fixed pattern, so that equal passages fall into
equal chunks wherever they stand. Chunks that occur at two places of different texts, or twice in one, are shared: one
occurrence is encoded and its ids go to all others. The remaining chunks are encoded where they stand.

A cut may split a word, so the tokens around a chunk join can be wrong. Each join is
repaired: a window from word start to word end around it is encoded anew, with one more word on both
sides. If the ids and places of those outer words are the ones of the chunks, the window replaces the tokens
between; if not, the window doubles its words, up to the whole text. Windows that meet become one, and a chunk that lies
inside a window is not encoded at all. Words are divided by blanks, tabs and line ends, which
no token contains, so a text without any is one window.

Texts are handled once per distinct text (by a 128-bit digest), and shuffled once: the representatives are
encoded and the results put together from the same exchange. Chunk references are 36 bytes per
``MEAN`` characters. A frequent chunk is split by ``salted_join``. Copies of a text get its result by the same join.

A null text is an empty one: no ids, empty decoded text. Repeated rows and equal ids keep a row each. Extra
columns are ignored; an empty table gives an empty result. Special tokens of the vocabulary in a text become their ids.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
import unicodedata
from collections.abc import Generator, Iterator, Mapping
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import digest
from lumenfold.plans.skew import salted_join
from lumenfold.plans.stage import stage

WINDOW = 32
LEAST, MEAN, MOST = 512, 2048, 16_384
BASE = 0x9E3779B97F4A7C15
BLOCK = 1 << 20
AT_ONCE, AT_ONCE_CHARS = 64, 1 << 18
OUT_CHARS = 1 << 20
BLANKS = (0x20, 0x09, 0x0A, 0x0D)
# Plain characters, words a dictionary holds at most, and the one plain capital whose lower case is longer.
PLAIN, MOST_WORDS, DOTTED_I = 0x180, 1 << 19, "\u0130"
# Normalizer and pre-tokenizer of the vocabularies whose words stand for themselves, and their pattern.
WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
WORD_END = "</w>"
PLAIN_SPACE = r"\t-\r\x20\x85\xa0"
PLAIN_BLANK = np.isin(np.arange(PLAIN), (9, 10, 11, 12, 13, 0x20, 0x85, 0xA0))


def plain_class(kind: str) -> str:
    """The plain characters of a Unicode category as a character class."""
    return "".join(f"\\u{c:04x}" for c in range(PLAIN) if unicodedata.category(chr(c)).startswith(kind))


# ``WORDS`` for plain lower-case texts, with its classes spelled out.
SPLIT = f"[{plain_class('L')}]+|[{plain_class('N')}]|'(?:s|t|re|ve|m|ll|d)|[^{PLAIN_SPACE}{plain_class('L')}{plain_class('N')}]+"


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


@cache
def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def candidates(points: np.ndarray) -> np.ndarray:
    """Places after which the hash of the last ``WINDOW`` characters asks for a cut."""
    out, back = [], pow(BASE, -1, 1 << 64)
    for at in range(0, len(points), BLOCK):
        low = max(0, at - WINDOW)
        block = points[low : at + BLOCK].astype(np.uint64)
        sums = np.cumsum(block * powers(BASE, BLOCK + WINDOW)[: len(block)])
        within = sums.copy()
        within[WINDOW:] -= sums[:-WINDOW]
        hashes = within * powers(back, BLOCK + WINDOW)[: len(block)]
        # A hash counts from the first full window on, so that equal passages agree wherever they start.
        hit = np.flatnonzero((hashes >> np.uint64(44)) & np.uint64(MEAN - 1) == 0) + low + 1
        out.append(hit[(hit > at) & (hit >= WINDOW)])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def chunk_starts(points: np.ndarray) -> list[int]:
    """First characters of the chunks of a text; at least ``LEAST`` and at most ``MOST`` characters apart."""
    n, starts = len(points), [0]
    if n <= LEAST:
        return starts
    cuts = candidates(points)
    while n - starts[-1] > LEAST:
        k = np.searchsorted(cuts, starts[-1] + LEAST)
        nxt = min(int(cuts[k]) if k < len(cuts) else n, starts[-1] + MOST)
        if nxt >= n:
            break
        starts.append(nxt)
    return starts


def grown(values: np.ndarray, size: int) -> np.ndarray:
    """``values`` with room for ``size``, doubled if need be."""
    return values if size <= len(values) else np.concatenate([values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)])


class Codec:
    """A tokenizer, from the JSON of its file, with its ids as arrays and the names of its tokens for decoding.

    A vocabulary that splits words as ``WORDS`` does, after lower case, gives equal words equal ids wherever they stand. For
    it, the words of plain texts are looked up in a dictionary, which the tokenizer itself fills; it is emptied
    at ``MOST_WORDS``. Plain are characters below ``PLAIN`` without special tokens: there neither composition nor lower case
    changes the number of characters. All other texts, and other vocabularies, go to the tokenizer as they are.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work over the cores
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(spec)
        self.model.no_truncation()
        self.model.no_padding()
        names = self.model.get_vocab(with_added_tokens=True)
        self.names = [""] * (max(names.values(), default=-1) + 1)
        for name, i in names.items():
            self.names[i] = name
        form = json.loads(spec)
        self.by_word = form["normalizer"] == NORMALIZER and form["pre_tokenizer"] == PRE_TOKENIZER and form["post_processor"] is None
        marks = [re.escape(t["content"]) for t in form["added_tokens"]]
        self.odd = re.compile("|".join([f"[^\\x00-{chr(PLAIN - 1)}]", DOTTED_I, *marks]))
        self.split = re.compile(SPLIT)
        self.ends_word = np.array([name.endswith(WORD_END) for name in self.names])
        self.sizes = np.array([len(name.removesuffix(WORD_END)) for name in self.names])
        self.words: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        """Empty the dictionary: word k has the ids from ``ends[k]`` to ``ends[k + 1]``."""
        self.words.clear()
        self.ids, self.places = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)

    def whole(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, first characters) of the tokens of each text, by the tokenizer."""
        out = []
        for at in range(0, len(texts), AT_ONCE):
            for e in self.model.encode_batch(texts[at : at + AT_ONCE], add_special_tokens=False):
                places = np.fromiter(itertools.chain.from_iterable(e.offsets), np.uint32)
                out.append((np.array(e.ids, np.uint32), places[::2]))
        return out

    def learn(self, words: set[str]) -> None:
        """Put new words into the dictionary. They are encoded as one text, in which a token with the end mark ends a word."""
        new = list(words)
        ids = np.array(self.model.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(new) or (len(ids) and ends[-1] != len(ids)):
            raise ValueError("the vocabulary does not mark the ends of words")
        # Tokens are bytes: the first byte of each, as a number of characters of its word.
        raw = np.frombuffer("".join(new).encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        first_byte = np.cumsum(self.sizes[ids]) - self.sizes[ids]
        begins = np.concatenate([[0], ends[:-1]])
        places = character[first_byte] - np.repeat(character[first_byte[begins]], ends - begins)
        old, known = int(self.ends[len(self.words)]), len(self.words)
        self.ids, self.places = grown(self.ids, old + len(ids)), grown(self.places, old + len(ids))
        self.ends = grown(self.ends, known + len(new) + 1)
        self.ids[old : old + len(ids)], self.places[old : old + len(ids)] = ids, places
        self.ends[known + 1 : known + len(new) + 1] = old + ends
        self.words.update(zip(new, range(known, known + len(new)), strict=True))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, first characters) of the tokens of each text."""
        out: list = [None] * len(texts)
        plain = [k for k, t in enumerate(texts) if self.by_word and not self.odd.search(t)]
        rest = sorted(set(range(len(texts))) - set(plain))
        for k, found in zip(rest, self.whole([texts[k] for k in rest]), strict=True):
            out[k] = found
        at = 0
        while at < len(plain):
            end, size = at, 0
            while end < len(plain) and (end == at or size < AT_ONCE_CHARS):
                size += len(texts[plain[end]])
                end += 1
            lowered = [texts[k].lower() for k in plain[at:end]]
            for k, found in zip(plain[at:end], self.looked_up(lowered), strict=True):
                out[k] = found
            at = end
        return out

    def looked_up(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids and places of plain texts from their words, which hold all characters but the white space."""
        together = "\n".join(texts)
        words = self.split.findall(together)
        if len(self.words) > MOST_WORDS:
            self.forget()
        if new := set(words).difference(self.words):
            self.learn(new)
        number = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        lens = np.fromiter(map(len, words), np.int64, len(words))
        solid = np.flatnonzero(~PLAIN_BLANK[np.frombuffer(together.encode("utf-16-le"), "<u2")])
        starts = solid[np.cumsum(lens) - lens]
        low, size = self.ends[number], self.ends[number + 1] - self.ends[number]
        upto = np.concatenate([[0], np.cumsum(size)])
        into = np.repeat(low - upto[:-1], size) + np.arange(upto[-1])
        ids, places = self.ids[into], self.places[into] + np.repeat(starts, size)
        offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        cuts = upto[np.searchsorted(starts, offsets)]
        return [(ids[a:b], (places[a:b] - o).astype(np.uint32)) for a, b, o in zip(cuts, cuts[1:], offsets, strict=False)]

    def decode(self, ids: np.ndarray) -> str:
        if self.model.decoder is not None:
            return self.model.decode(ids.tolist(), skip_special_tokens=False)
        return " ".join(map(self.names.__getitem__, ids.tolist()))


@cache
def process_codec(spec: str) -> Codec:
    """One codec for all tasks of a Python process, which so share its dictionary."""
    return Codec(spec)


def between(part: tuple[np.ndarray, np.ndarray], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that start in [low, high)."""
    ids, places = part
    inside = (places >= low) & (places < high)
    return ids[inside], places[inside]


def agree(a: tuple[np.ndarray, np.ndarray], at_a: int, b: tuple[np.ndarray, np.ndarray], at_b: int, low: int, high: int) -> bool:
    """Whether two encodings, of parts that begin at ``at_a`` and ``at_b`` of a text, have the same tokens in [low, high)."""
    (ids, places), (ids2, places2) = between(a, low - at_a, high - at_a), between(b, low - at_b, high - at_b)
    return np.array_equal(ids, ids2) and np.array_equal(places.astype(np.int64) + at_a, places2.astype(np.int64) + at_b)


def encode_text(text: str, codec: Codec, given: Mapping[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The ids of a whole text from its chunks; ``given`` holds those that are encoded already."""
    return encode_many([(text, given)], codec)[0]


def encode_many(texts: list[tuple[str, Mapping]], codec: Codec) -> list[np.ndarray]:
    """The ids of several texts; what they ask the codec for goes to it together."""
    out: list = [None] * len(texts)
    steps = {k: encoding(text, given) for k, (text, given) in enumerate(texts)}
    answers = dict.fromkeys(steps)
    while steps:
        asked = {}
        for k, step in list(steps.items()):
            try:
                asked[k] = step.send(answers[k])
            except StopIteration as done:
                out[k] = done.value
                del steps[k]
        found = iter(codec.encode([t for wanted in asked.values() for t in wanted]))
        answers = {k: [next(found) for _ in wanted] for k, wanted in asked.items()}
    return out


def encoding(text: str, given: Mapping[int, tuple[np.ndarray, np.ndarray]]) -> Generator[list[str], list, np.ndarray]:
    """Yields the parts it wants to have encoded, is sent their tokens, and returns the ids of the text."""
    points = code_points(text)
    starts = chunk_starts(points)
    if len(starts) == 1:
        return given[0][0] if 0 in given else (yield [text])[0][0]
    n, joins = len(points), np.array(starts[1:])
    blank = functools.reduce(np.logical_or, [points == b for b in BLANKS])
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    firsts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)  # word k is [firsts[k], ends[k])
    words = np.ones(len(joins), np.int64)
    done: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    chunks = dict(given)
    while True:
        left = np.searchsorted(firsts, joins) - 1 - words
        right = np.searchsorted(ends, joins, side="right") + words
        begin = np.where(left >= 0, firsts[np.maximum(left, 0)] if len(firsts) else 0, 0)
        end = np.where(right < len(ends), ends[np.minimum(right, len(ends) - 1)] if len(ends) else n, n)
        windows: list[list[int]] = []
        for k, (a, b) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
            if windows and a <= windows[-1][1]:
                windows[-1][1:] = [max(b, windows[-1][1]), windows[-1][2], k]
            else:
                windows.append([a, b, k, k])
        # Chunks that are not inside a window: number, and the part of it that stays.
        rest = [(0, 0), *((w[3] + 1, w[1]) for w in windows)]
        limits = [*((w[2], w[0]) for w in windows), (len(joins), n)]
        stay = [(c, low, high) for (c, low), (last, high) in zip(rest, limits, strict=True) if low < high and c == last]
        missing = [c for c, _, _ in stay if c not in chunks]
        bounds = [*starts, n]
        todo = [(a, b) for a, b, _, _ in windows if (a, b) not in done]
        found = yield [text[bounds[c] : bounds[c + 1]] for c in missing] + [text[a:b] for a, b in todo]
        chunks.update(zip(missing, found[: len(missing)], strict=True))
        done.update(zip(todo, found[len(missing) :], strict=True))
        kept = {c: (low, high) for c, low, high in stay}
        bad = []
        for a, b, first, last in windows:
            window, fine = done[a, b], True
            if first in kept:  # the word after a, in the chunk before the first join
                fine &= agree(window, a, chunks[first], starts[first], a, int(ends[np.searchsorted(ends, a, side="right")]))
            if last + 1 in kept:  # the word before b, in the chunk after the last join
                fine &= agree(window, a, chunks[last + 1], starts[last + 1], int(firsts[np.searchsorted(firsts, b) - 1]), b)
            if not fine:
                bad += range(first, last + 1)
        if not bad:
            break
        words[bad] *= 2
    parts = [(low, between(chunks[c], low - starts[c], high - starts[c])[0]) for c, low, high in stay]
    parts += [(a, done[a, b][0]) for a, b, _, _ in windows]
    return np.concatenate([ids for _, ids in sorted(parts, key=lambda p: p[0])])


def texts_of(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(digest(text).alias("text_key"), text.alias("text"))


def chunk_rows(docs: DataFrame) -> DataFrame:
    """(chunk, text_key, nth) of every chunk of every distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nth, of = [], [], []
            for r, text in enumerate(batch.column("text")):
                whole = text.as_py()
                starts = chunk_starts(code_points(whole))
                for k, (a, b) in enumerate(itertools.pairwise([*starts, len(whole)])):
                    keys.append(hashlib.blake2b(whole[a:b].encode(), digest_size=16).digest())
                    nth.append(k)
                    of.append(r)
            columns = [pa.array(keys, pa.binary()), batch.column("text_key").take(pa.array(of, pa.int64())), pa.array(nth, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "text_key", "nth"])

    return texts_of(docs).mapInArrow(run, "chunk binary, text_key binary, nth int").distinct()


def encode_representatives(texts: DataFrame, shared: DataFrame, spec: str) -> DataFrame:
    """(chunk, ids, places) of every shared chunk, encoded in the text that represents it."""
    asked = shared.groupBy(F.col("first.text_key").alias("text_key")).agg(F.collect_list(F.struct("first.nth", "chunk")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            for text, asked in zip(batch.column("text"), batch.column("asked"), strict=True):
                if not asked.is_valid:
                    continue
                codec = codec or process_codec(spec)
                whole, wanted = text.as_py(), asked.as_py()
                bounds = [*chunk_starts(code_points(whole)), len(whole)]
                for at in range(0, len(wanted), AT_ONCE):
                    now = wanted[at : at + AT_ONCE]
                    found = codec.encode([whole[bounds[w["nth"]] : bounds[w["nth"] + 1]] for w in now])
                    columns = [[w["chunk"] for w in now], *([p[i].astype("<u4").tobytes() for p in found] for i in (0, 1))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["chunk", "ids", "places"])

    return texts.join(asked, "text_key", "left").mapInArrow(run, "chunk binary, ids binary, places binary")


def encode_texts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(text_key, ids, decoded) of every distinct text; ``ids`` as little-endian unsigned 32-bit integers."""
    spec = Path(tokenizer).read_text()  # a vocabulary of a few MB, sent to the tasks: executors need no file
    rows = stage(chunk_rows(docs), "chunks")
    place = F.struct("text_key", "nth")
    summed = rows.groupBy("chunk").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("rows"))
    shared = stage(summed.where("first <> last").drop("last"), "shared-chunks")
    # Both uses of the texts read one exchange.
    texts = texts_of(docs).groupBy("text_key").agg(F.max("text").alias("text"))
    weights = shared.select("chunk", "rows")
    coded = encode_representatives(texts, shared, spec)
    wanted = rows.join(shared.select("chunk"), "chunk", "left_semi")
    sent = salted_join(wanted, coded, "chunk", weights, ["text_key", "nth"])
    given = sent.groupBy("text_key").agg(F.collect_list(F.struct("nth", "ids", "places")).alias("given"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = process_codec(spec)
        for batch in batches:
            now, size = [], 0
            for key, text, given in zip(*(batch.column(c) for c in ("text_key", "text", "given")), strict=True):
                parts = {
                    g["nth"].as_py(): tuple(np.frombuffer(g[c].as_py(), "<u4") for c in ("ids", "places")) for g in given.values or ()
                } if given.is_valid else {}
                now.append((key.as_py(), text.as_py(), parts))
                size += len(now[-1][1])
                if size > OUT_CHARS:
                    yield table(now, codec)
                    now, size = [], 0
            yield table(now, codec)

    def table(now: list, codec: Codec) -> pa.RecordBatch:
        ids = encode_many([(text, parts) for _, text, parts in now], codec)
        columns = [[key for key, _, _ in now], [i.astype("<u4").tobytes() for i in ids], [codec.decode(i) for i in ids]]
        kinds = [pa.binary(), pa.binary(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["text_key", "ids", "decoded"])

    return texts.join(given, "text_key", "left").mapInArrow(run, "text_key binary, ids binary, decoded string")


def encode(docs: DataFrame, tokenizer: str, derive: Mapping[str, Column] | None = None) -> DataFrame:
    """Per document row: doc_id and, from ``ids`` and ``decoded`` of its text, the columns ``derive`` (default: both).

    They are derived once per distinct text, before the results are joined to the documents.
    """
    derive = derive or {"ids": F.col("ids"), "decoded": F.col("decoded")}
    results = encode_texts(docs, tokenizer).select("text_key", *[c.alias(name) for name, c in derive.items()])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", digest(text).alias("text_key"))
    joined = salted_join(rows, results, "text_key", rows.groupBy("text_key").agg(F.count("*").alias("rows")), ["doc_id"])
    return joined.select("doc_id", *derive)


def digests() -> dict[str, Column]:
    """Number of ids, and SHA-256 of the ids and of the decoded text."""
    return {
        "n_tokens": F.expr("octet_length(ids) div 4").cast("long"),
        "ids_sha256": F.sha2("ids", 256),
        "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256),
    }
