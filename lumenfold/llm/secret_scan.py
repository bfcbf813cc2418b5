"""Secret scan by patterns and by sliding-window entropy, in native expressions only.

Pattern kinds (leftmost, non-overlapping matches per kind; failing ones are dropped):

assign  a key word, an assignment sign and a value of 6 or more characters
access  AKIA and upper-case letters or digits, 20 or more characters
hex     24 or more lower-case hex digits

Entropy kinds, one per character class: maximal runs of the class are candidates. A window of
``WINDOW`` characters slides over each; the counts of its characters change by one in and one
out, and the sum of c * log2(c) with them, so that the Shannon entropy log2(w) - sum / w
is known at every step. Windows at or above the limit of the class are merged. Runs consist of pieces, divided by
``/`` and ``=``; a span reaches over the whole pieces that merged windows touch, from the first to the last that is not
allow-listed. Allow-listed are pieces that are plain words, numbers or UUIDs, and pieces whose part under the windows
holds a placeholder or a run of consecutive characters: other pieces of the run are judged by themselves.
Spans inside a pattern match are suppressed. Spans count code points, end exclusive.

A null text is an empty one and has no spans. Everything happens inside a row: no shuffle,
whatever repeats; equal ids do not matter, extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.common import fresh, let

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA)([A-Z0-9]+)"
HEX = r"()([0-9a-f]{24,})"
# name, pattern with the judged part as group 2, least length of group 2 (of the match: + the fixed part)
KINDS = (("assign", ASSIGN, 6), ("access", ACCESS, 16), ("hex", HEX, 24))
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"

WINDOW = 20


@dataclass(frozen=True)
class CharClass:
    """A character class: its kind, alphabet (upper case folded if ``fold``), and least entropy in bits."""

    kind: str
    pattern: str
    alphabet: str
    least_bits: float
    fold: bool = False


CLASSES = (
    CharClass("entropy_hex", "[0-9A-Fa-f]", "0123456789abcdef", 3.0, fold=True),
    CharClass(
        "entropy_base64",
        "[A-Za-z0-9+/_=-]",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_=",
        3.8,
    ),
)
# What a whole piece may be, and what the part of it under the windows may hold.
PLAIN_PIECES = (
    r"^(?:[A-Z]{0,3}[a-z]{2,})+[A-Z]{0,3}$",
    r"^[A-Z]+$",
    r"^[0-9]+$",
    r"^[-_+]*$",
    r"^[a-z]+(?:[-_+][a-z]+)*$",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
)
PLACEHOLDERS = (
    r"(?i)example|sample|placeholder|changeme|dummy|your[_-]",
    r"(?i)0123456789|abcdefghij|(.)\1{7}",
)
# Matches are located in groups of this many, so that no list is copied once per match of a long text.
TOGETHER = 256
# Counts of a window's characters are packed into long numbers, this many to each, of this many bits.
PACKED, BITS = 12, 5


def located(text: Column, pattern: str) -> Column:
    """(start, end, found, judged) of the leftmost non-overlapping matches; judged is group 2.

    The pieces between the matches and the matches themselves add up to the positions: within groups of ``TOGETHER``
    first, then over the groups.
    """
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("judged"),
    )
    match = "struct<start:int,end:int,found:string,judged:string>"
    nothing = F.array().cast(f"array<{match}>")

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["found"]), F.lit(0))
        new = F.struct(start.alias("start"), end.alias("end"), part["found"].alias("found"), part["judged"].alias("judged"))
        more = F.when(part["found"].isNotNull(), F.concat(done["out"], F.array(new))).otherwise(done["out"])
        return F.struct(end.alias("at"), more.alias("out"))

    def group(some: Column) -> Column:
        return F.aggregate(some, F.struct(F.lit(0).alias("at"), nothing.alias("out")), step)

    def groups(every: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(every), F.lit(1)), F.lit(TOGETHER))
        return F.transform(firsts, lambda n: group(F.slice(every, n, F.lit(TOGETHER))))

    def place(done: Column, one: Column) -> Column:
        moved = F.struct(done["at"].alias("by"), one["out"].alias("out"))
        return F.struct((done["at"] + one["at"]).alias("at"), F.concat(done["all"], F.array(moved)).alias("all"))

    def shifted(one: Column) -> Column:
        return F.transform(
            one["out"],
            lambda m: F.struct(
                (m["start"] + one["by"]).alias("start"), (m["end"] + one["by"]).alias("end"), m["found"].alias("found"), m["judged"].alias("judged")
            ),
        )

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<by:int,out:array<{match}>>>").alias("all"))
    placed = F.aggregate(let(parts, groups), begin, place, lambda done: done["all"])
    return F.flatten(F.transform(placed, shifted))


def pattern_spans(text: Column, rank: int) -> Column:
    """Spans of one pattern kind. Only a text with a match is taken apart."""
    kind, pattern, least = KINDS[rank]
    kept = F.filter(located(text, pattern), lambda m: F.length(m["judged"]) >= least)
    return F.when(text.rlike(pattern), F.transform(kept, lambda m: span(m["start"], m["end"], kind, rank))).otherwise(none())


def span(start: Column, end: Column, kind: str, rank: int) -> Column:
    return F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))


def none() -> Column:
    return F.array().cast(SPAN)


def windows_above(run: Column, chars: CharClass, window: int = WINDOW) -> Column:
    """Merged (start, end) of the windows in ``run`` whose entropy reaches the limit of the class.

    The state holds the counts of the window, packed into a few numbers, and their sum of c * log2(c). The entering and
    the leaving character change one count each; the same character in and out changes none.
    """
    letters = F.transform(F.split(F.lower(run) if chars.fold else run, ""), lambda c: F.instr(F.lit(chars.alphabet), c) - 1)
    left = F.concat(F.array_repeat(F.lit(None).cast("int"), window), letters)
    moves = F.slice(F.arrays_zip(letters.alias("into"), left.alias("out")), F.lit(1), F.length(run))
    parts = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    most_sum = window * (math.log2(window) - chars.least_bits) + 1e-9
    hit = "struct<start:int,end:int>"
    word = lambda c: F.floor(c / PACKED).cast("int")
    shift = lambda c: (c % PACKED * BITS).cast("int")
    one = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), shift(c))

    def count(counts: Column, c: Column) -> Column:
        packed = F.call_function("shiftright", F.get(counts, word(c)), shift(c))
        return packed.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    def slide(state: Column, move: Column) -> Column:
        into, out = move["into"], move["out"]
        gained, lost = count(state["counts"], into), count(state["counts"], out)
        grown = F.get(parts, gained + 1) - F.get(parts, gained)
        shrunk = F.when(out.isNull(), F.lit(0.0)).otherwise(F.get(parts, lost - 1) - F.get(parts, lost))
        same = F.coalesce(into == out, F.lit(False))
        more = lambda x, i: F.when(i == word(into), x + one(into)).otherwise(x)
        less = lambda x, i: F.when(i == word(out), x - one(out)).otherwise(x)
        return F.struct(
            (state["k"] + 1).alias("k"),
            F.when(same, state["counts"]).otherwise(F.transform(F.transform(state["counts"], more), less)).alias("counts"),
            (state["total"] + F.when(same, F.lit(0.0)).otherwise(grown + shrunk)).alias("total"),
            state["open"].alias("open"),
            state["hits"].alias("hits"),
        )

    def judge(state: Column) -> Column:
        """A good window lengthens the open hit, or closes it and opens another."""
        start, end = state["k"] - window, state["k"]
        good = (start >= 0) & (state["total"] <= most_sum)
        joins = F.coalesce(state["open"]["end"] >= start, F.lit(False))
        new = F.struct(F.when(joins, state["open"]["start"]).otherwise(start).alias("start"), end.alias("end"))
        closes = good & ~joins & state["open"].isNotNull()
        return F.struct(
            state["k"].alias("k"),
            state["counts"].alias("counts"),
            state["total"].alias("total"),
            F.when(good, new).otherwise(state["open"]).alias("open"),
            F.when(closes, F.concat(state["hits"], F.array(state["open"]))).otherwise(state["hits"]).alias("hits"),
        )

    begin = F.struct(
        F.lit(0).alias("k"),
        F.array_repeat(F.lit(0).cast("long"), -(-len(chars.alphabet) // PACKED)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(None).cast(hit).alias("open"),
        F.array().cast(f"array<{hit}>").alias("hits"),
    )
    every = lambda s: F.when(s["open"].isNull(), s["hits"]).otherwise(F.concat(s["hits"], F.array(s["open"])))
    return F.aggregate(moves, begin, lambda s, m: let(slide(s, m), judge), every)


def pieces_of(run: Column) -> Column:
    """(start, end) of the pieces of a run between its dividers."""
    divided = located(run, r"()([/=])")
    starts = F.concat(F.array(F.lit(0)), F.transform(divided, lambda m: m["end"]))
    ends = F.concat(F.transform(divided, lambda m: m["start"]), F.array(F.length(run)))
    return F.filter(F.arrays_zip(starts.alias("start"), ends.alias("end")), lambda p: p["start"] < p["end"])


def kept_span(run: Column, pieces: Column, hit: Column) -> Column:
    """(start, end) over the pieces under a hit that are not allow-listed; null if all are."""
    text = lambda a, b: F.substring(run, a + 1, b - a)
    any_of = lambda value, patterns: functools.reduce(lambda x, y: x | y, [value.rlike(p) for p in patterns])

    def secret(p: Column) -> Column:
        under = text(F.greatest(p["start"], hit["start"]), F.least(p["end"], hit["end"]))
        touched = (p["start"] < hit["end"]) & (p["end"] > hit["start"])
        return touched & ~any_of(text(p["start"], p["end"]), PLAIN_PIECES) & ~any_of(under, PLACEHOLDERS)

    def reach(kept: Column) -> Column:
        ends = F.struct(F.get(kept, F.lit(0))["start"].alias("start"), F.get(kept, F.size(kept) - 1)["end"].alias("end"))
        return F.when(F.size(kept) > 0, ends)

    return let(F.filter(pieces, secret), reach)


def entropy_spans(text: Column, which: int, window: int = WINDOW) -> Column:
    """Spans of one entropy kind. Only a text with a candidate is taken apart."""
    chars, rank = CLASSES[which], len(KINDS) + which
    pattern = f"()({chars.pattern}{{{window},}})"

    def of_run(run: Column) -> Column:
        def spans(hits: Column) -> Column:
            kept = lambda pieces: F.transform(hits, lambda h: kept_span(run["found"], pieces, h))
            found = F.array_distinct(F.filter(let(pieces_of(run["found"]), kept), lambda s: s.isNotNull()))
            return F.transform(found, lambda s: span(run["start"] + s["start"], run["start"] + s["end"], chars.kind, rank))

        # Pieces are made only for runs with a hit.
        return let(windows_above(run["found"], chars, window), lambda hits: F.when(F.size(hits) > 0, spans(hits)).otherwise(none()))

    return F.when(text.rlike(pattern), F.flatten(F.transform(located(text, pattern), of_run))).otherwise(none())


def with_spans(docs: DataFrame, text: str, base: str, spans: str, window: int = WINDOW) -> DataFrame:
    """Add the pattern spans as ``base`` and all spans as ``spans``, both ordered by start and kind."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = docs.withColumn(base, F.array_sort(F.concat(*[pattern_spans(whole, r) for r in range(len(KINDS))])))
    inside = lambda s: F.exists(base, lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"]))
    more = F.concat(*[entropy_spans(whole, c, window) for c in range(len(CLASSES))])
    return found.withColumn(spans, F.array_sort(F.concat(base, F.filter(more, lambda s: ~inside(s)))))


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans."""
    found = with_spans(docs.select("doc_id", "text"), "text", "_base", "_spans", window)
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind, _, _ in KINDS],
        (F.size("_spans") - F.size("_base")).cast("long").alias("n_entropy"),
        F.sha2(span_text(F.col("_base")), 256).alias("base_sha256"),
        span_text(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with every span, overlapping ones together, replaced by ``mark``. Other texts stay as they are."""
    base, spans = fresh(docs, "base_spans"), fresh(docs, "all_spans")
    found = with_spans(docs, text, base, spans, window)
    whole = F.col(text)

    def step(done: Column, s: Column) -> Column:
        # A span that begins before the end of the last one only lengthens it: its mark is already there.
        apart = s["start"] >= done["at"]
        gap = F.substring(whole, done["at"] + 1, s["start"] - done["at"])
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"]).alias("out"),
        )

    rest = lambda d: F.concat(d["out"], F.substring(whole, d["at"] + 1, F.length(whole) - d["at"]))
    clean = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)
    return found.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(whole)).drop(base, spans)
