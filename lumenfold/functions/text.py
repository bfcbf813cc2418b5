"""Column expressions on text: words, tokens, letters, key hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space, and the token pattern (a punctuation
# mark, or a word with an optional # or @ before it and an optional short suffix
# after an apostrophe).
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
TOKEN = r"""((?:[\.,!?;"])|(?:(?:\#|\@)?[A-Za-z0-9_\-]+(?:\'[a-z]{1,3})?))"""
LETTERS = "abcdefghijklmnopqrstuvwxyz"

# The two letters outside A-Z whose lower case holds one of a-z: the Kelvin sign is a k,
# the dotted capital I is a letter of its own.
_KELVIN, _DOTTED_I = "\u212a", "\u0130"


def lower_words(text: Column) -> Column:
    """White-space separated words in lower case; may hold an empty first or last element."""
    return F.split(F.lower(text), WHITESPACE)


def tokens(text: Column) -> Column:
    """Array of tokens in their original case."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1))


def lower_all(token_array: Column) -> Column:
    """Lower-case every token. Tokens hold no blanks, so one call serves the whole array."""
    return F.split(F.lower(F.array_join(token_array, " ")), " ")


def lower_text(text: Column) -> Column:
    """The text in lower case, for counting a-z in it with :func:`letter_counts`."""
    return F.lower(F.replace(text, F.lit(_DOTTED_I), F.lit("")))


def other_letters(text: Column) -> Column:
    """Array of the letters outside a-z, lower-cased one by one."""
    beyond_ascii = F.regexp_replace(text, r"[\x00-\x7f]+", "")
    kept = F.regexp_replace(beyond_ascii, rf"[^\p{{L}}]+|{_KELVIN}", "")
    letters = F.filter(F.split(kept, ""), lambda c: c != "")
    return F.transform(letters, lambda c: F.lower(c))


def letter_counts(text: Column) -> Column:
    """How often each of a-z occurs, as an array in the order of the alphabet. Every byte is looked at once."""

    @F.arrow_udf("array<bigint>")
    def counts(texts: pa.Array) -> pa.Array:
        flat = texts.cast(pa.large_binary())
        _, offsets, data = flat.buffers()
        ends = np.frombuffer(offsets, np.int64)[flat.offset : flat.offset + len(flat) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        rows = [np.bincount(raw[a:b], minlength=256)[97:123] for a, b in zip(ends, ends[1:], strict=False)]
        return pa.array(rows, pa.list_(pa.int64()))

    return counts(text)


def run_lengths(values: Column) -> Column:
    """Array of (value, n) for the distinct elements of an array of strings.

    Sorts the array and measures the runs, so the cost is that of the sort.
    """

    def measure(ordered: Column) -> Column:
        size = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))),
            lambda i: (i < size) & ((i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))),
        )
        return _bind(
            starts,
            lambda first: F.zip_with(
                first,
                F.slice(first, F.lit(2), F.greatest(F.size(first), F.lit(1))),
                lambda a, b: F.struct(
                    F.get(ordered, a).alias("value"),
                    (F.coalesce(b, size) - a).cast("long").alias("n"),
                ),
            ),
        )

    return _bind(F.sort_array(values), measure)


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def key_digest(key: Column, salt: str = "") -> Column:
    """Hexadecimal MD5 of a key. Its text order is a repeatable random order of the keys."""
    text = key.cast("string")
    return F.md5((F.concat(F.lit(salt), text) if salt else text).cast("binary"))


def key_bucket(key: Column, buckets: int) -> Column:
    """Bucket 0 .. ``buckets - 1`` of a key, from the first 32 bits of its MD5."""
    return F.conv(F.substring(key_digest(key), 1, 8), 16, 10).cast("long") % F.lit(buckets)
