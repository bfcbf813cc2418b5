"""Quotation linking in conversations, in native expressions only.

A line belongs to the quote level that its leading '>' marks give. Neighbouring lines of one level are a
passage; those of level 0 are the message's own. Passages are normalised (lower case, letters
and digits only, single blanks) and hashed. A quoted passage is joined to its original: the
earliest earlier message of the conversation that has the passage as its own text, paragraph, passage or
line; a passage without any, to an earlier message of the conversation that holds its lines or sentences in
their order (``part_links``); before that, if it has at least ``LEAST_WORDS`` words, the earliest such message of any other
conversation. A letter of a script without blanks counts as a word.

A message replies to the first original in its own conversation that it quotes at the lowest level; one without such
a link opens a thread. Threads come in the order of their first turns, and their messages by turn,
so each reply stands behind its original. ``position`` numbers that order from 0.

Originals are reduced to one row per passage and conversation before they are joined, so frequent
passages do not multiply; only passages that are quoted are kept. Positions come from a range
sort and partition counts, so no conversation is gathered in one task. Threads are
found by pointer jumping, with a written table per round.

A null text is an empty one. Rows with the same conversation and turn are separate messages with the
same place in the thread, ordered by role and text. Messages without conversation or turn are kept, without links, and without
position if the conversation is missing. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lumenfold.llm.common import let
from lumenfold.plans.stage import stage

LEAST_WORDS = 3
UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"
MARKS = r"^[ \t]*((?:>[ \t]*)+)"


def normal(text: Column) -> Column:
    """Lower case, letters and digits only, single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def passage_hash(text: Column) -> Column:
    """16 bytes for a normalised passage; null if it has no letter or digit."""
    plain = normal(text)
    return F.when(plain != "", F.unhex(F.md5(plain)))


def long_enough(text: Column) -> Column:
    """Whether a passage has ``LEAST_WORDS`` words."""
    return F.size(F.split(F.trim(F.regexp_replace(normal(text), UNSPACED, " $1 ")), " +")) >= LEAST_WORDS


def with_passages(messages: DataFrame) -> DataFrame:
    """Add ``passages``: (level, body) of every run of lines of one quote level.

    The lines of a text and the places where its passages start are each made once and used by name.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # A line without a mark has no first group, so its level is zero.
    level = lambda l: F.length(F.regexp_replace(F.regexp_extract(l, MARKS, 1), "[ \t]", ""))  # noqa: E731, E741
    line = lambda l: F.struct(level(l).alias("level"), F.regexp_replace(l, MARKS, "").alias("body"))  # noqa: E731, E741

    def starts(lines: Column) -> Column:
        opens = lambda i: (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"])
        return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), opens)

    def cut(lines: Column, first: Column) -> Column:
        def passage(start: Column, k: Column) -> Column:
            end = F.coalesce(F.get(first, k + 1), F.size(lines))
            body = F.array_join(F.transform(F.slice(lines, start + 1, end - start), lambda x: x["body"]), "\n")
            return F.struct(F.get(lines, start)["level"].alias("level"), body.alias("body"))

        return F.transform(first, passage)

    quoted = let(F.transform(F.split(text, r"\r?\n", -1), line), lambda lines: let(starts(lines), lambda first: cut(lines, first)))
    plain = F.array(F.struct(F.lit(0).alias("level"), text.alias("body")))
    return messages.withColumn("passages", F.when(text.rlike(r"(?m)^[ \t]*>"), quoted).otherwise(plain))


def units(body: Column) -> list[Column]:
    """The normalised lines of a text, and its normalised sentences wherever its lines are broken."""
    kept = lambda parts: F.filter(F.transform(parts, normal), lambda x: x != "")
    sentences = F.split(F.regexp_replace(body, r"[ \t]*\n[ \t]*", " "), r"(?<=[.!?。！？])\s*(?=\S)", -1)
    return [kept(F.split(body, r"\n", -1)), kept(sentences)]


def chained(parts: Column) -> Column:
    """Neighbouring units two by two, or the only one: what a text must hold to hold the units in their order."""
    pairs = lambda u: F.transform(F.sequence(F.lit(1), F.size(u) - 1), lambda i: F.concat(F.get(u, i - 1), F.lit("\n"), F.get(u, i)))
    return let(parts, lambda u: F.when(F.size(u) < 2, u).otherwise(pairs(u)))


def hashed(parts: Column) -> Column:
    return F.array_distinct(F.transform(parts, lambda x: F.unhex(F.md5(x))))


def own_text(passages: Column) -> Column:
    """The message without its quotes."""
    return F.trim(F.array_join(F.transform(F.filter(passages, lambda p: p["level"] == 0), lambda p: p["body"]), "\n"))


def links(messages: DataFrame, short: bool = False) -> DataFrame:
    """(conv_id, turn, level, nth, hash, to_conv, to_turn) of every quoted passage that is long enough.

    With ``short``, also of the others, which link only within their conversation.
    """
    spread = messages.select("conv_id", "turn", F.posexplode("passages").alias("nth", "passage")).where("passage.level > 0")
    body, level = F.col("passage.body"), F.col("passage.level").alias("level")
    quotes = spread.select("conv_id", "turn", "nth", level, passage_hash(body).alias("hash"), long_enough(body).alias("far"))
    quotes = stage(quotes.where("hash IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL").where(F.lit(short) | F.col("far")), "quotes")

    own = F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: p["body"])
    whole = own_text(F.col("passages"))
    parts = F.concat(F.array(whole), own, F.split(whole, r"\n[ \t]*\n"), F.split(whole, r"\n"))
    known = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    passages = known.select("conv_id", "turn", F.explode(F.array_distinct(F.transform(parts, passage_hash))).alias("hash"))
    asked = quotes.select("hash").distinct()
    originals = passages.where("hash IS NOT NULL").join(asked, "hash", "left_semi")
    first = stage(originals.groupBy("hash", "conv_id").agg(F.min("turn").alias("first")), "originals")
    # The two earliest conversations are enough: one of them is not the quoting one.
    place = F.struct(F.col("conv_id").alias("to_conv"), F.col("first").alias("to_turn"))
    earliest = first.groupBy("hash").agg(F.min(place).alias("a"))
    second = first.join(earliest, "hash").where(F.col("conv_id") != F.col("a.to_conv")).groupBy("hash").agg(F.min(place).alias("b"))
    anywhere = earliest.join(second, "hash", "left")
    found = quotes.join(first, ["hash", "conv_id"], "left").join(anywhere, "hash", "left")
    inside = F.col("first") < F.col("turn")
    other = F.when(F.col("far"), F.when(F.col("a.to_conv") != F.col("conv_id"), F.col("a")).otherwise(F.col("b")))
    return found.select(
        "conv_id",
        "turn",
        "level",
        "nth",
        "hash",
        F.when(inside, F.col("conv_id")).otherwise(other["to_conv"]).alias("to_conv"),
        F.when(inside, F.col("first")).otherwise(other["to_turn"]).alias("to_turn"),
    )


def part_links(messages: DataFrame, linked: DataFrame) -> DataFrame:
    """``linked`` with originals in the same conversation for passages without any that quote parts of a message.

    A message holds a passage if it holds all its neighbouring lines in pairs, or all its neighbouring sentences. The
    candidate is the earlier message where the last of these pairs first appears: no earlier message can hold
    them all. It is the original if it holds all of them. So a passage has one candidate per kind, however frequent its lines are.
    """
    open_ones = stage(linked.where("to_conv IS NULL").select("conv_id", "turn", "nth"), "open-quotes")
    if open_ones.isEmpty():
        return linked
    spread = messages.select("conv_id", "turn", F.posexplode("passages").alias("nth", "passage")).where("passage.level > 0")
    wanted = spread.join(open_ones, ["conv_id", "turn", "nth"]).distinct()
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), hashed(chained(u)).alias("parts")) for k, u in enumerate(units(F.col("passage.body")))])
    listed = wanted.select("conv_id", "turn", "nth", F.explode(kinds).alias("k")).select("conv_id", "turn", "nth", "k.kind", "k.parts")
    asked = stage(listed.select("conv_id", "turn", "nth", "kind", F.size("parts").alias("size"), F.explode("parts").alias("part")), "quoted-parts")

    known = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL").join(open_ones.select("conv_id").distinct(), "conv_id", "left_semi")
    own = own_text(F.col("passages"))
    singles = [F.concat(u, chained(u)) for u in units(own)]
    parts = known.select("conv_id", F.col("turn").alias("at"), F.explode(F.array_distinct(F.concat(*[hashed(p) for p in singles]))).alias("part"))
    held = stage(parts.join(asked.select("conv_id", "part").distinct(), ["conv_id", "part"], "left_semi").distinct(), "held-parts")
    first = held.groupBy("conv_id", "part").agg(F.min("at").alias("first"))
    key = ["conv_id", "turn", "nth", "kind"]
    candidates = asked.join(first, ["conv_id", "part"]).groupBy(*key, "size").agg(F.max("first").alias("at"), F.count("*").alias("found"))
    candidates = stage(candidates.where("found = size AND at < turn").drop("found"), "quote-candidates")
    checked = asked.drop("size").join(candidates, key).join(held, ["conv_id", "at", "part"])
    whole = checked.groupBy(*key, "size", "at").agg(F.count("*").alias("found")).where("found = size")
    best = whole.groupBy("conv_id", "turn", "nth").agg(F.min("at").alias("part_turn"))
    joined = linked.join(best, ["conv_id", "turn", "nth"], "left")
    mine = F.col("to_conv").isNull() & F.col("part_turn").isNotNull()
    return joined.select(
        "conv_id",
        "turn",
        "level",
        "nth",
        "hash",
        F.when(mine, F.col("conv_id")).otherwise(F.col("to_conv")).alias("to_conv"),
        F.when(mine, F.col("part_turn")).otherwise(F.col("to_turn")).alias("to_turn"),
    )


def threads(linked: DataFrame) -> DataFrame:
    """(conv_id, turn, parent, root, depth) of every message that replies to one of its own conversation."""
    inner = linked.where(F.col("to_conv") == F.col("conv_id"))
    parents = inner.groupBy("conv_id", "turn").agg(F.min_by("to_turn", F.struct("level", "nth")).alias("parent"))
    now = stage(parents.withColumns({"root": F.col("parent"), "depth": F.lit(1)}), "threads")
    while True:
        above = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        joined = now.join(above, ["conv_id", "root"], "left")
        after = joined.select(
            "conv_id",
            "turn",
            "parent",
            F.coalesce("next", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("next").isNotNull().alias("moved"),
        )
        after = stage(after, "threads")
        more = after.where("moved").limit(1).count()
        now = after.drop("moved")
        if not more:
            return now


def numbered(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Add ``position``: the rank of a row by ``order`` among those of its ``key``, from 0."""
    ranged = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    ordered = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    counts = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    begins = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_begin"))
    global_at = F.col("_begin") + F.col("_at") - F.shiftleft("_part", 33)
    placed = ordered.withColumn("_part", part).join(begins, "_part").withColumn("_place", global_at)
    firsts = placed.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("_place").alias("_first"))
    joined = placed.join(firsts, key, "left").withColumn("position", F.col("_place") - F.col("_first"))
    return joined.drop("_at", "_part", "_begin", "_place", "_first")


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, role, position, thread, depth, parent, n_quotes, n_linked, max_level, content."""
    plain = conversations.select("conv_id", "turn", "role", F.col("text").cast("string").alias("text"))
    messages = with_passages(plain)
    linked = stage(part_links(messages, stage(links(messages, short=True), "whole-links")), "quote-links")
    counts = linked.groupBy("conv_id", "turn").agg(F.count("to_turn").alias("n_linked"))
    quoted = F.filter("passages", lambda p: p["level"] > 0)
    rows = messages.select(
        "conv_id",
        "turn",
        "role",
        F.size(quoted).cast("long").alias("n_quotes"),
        F.array_max(F.transform("passages", lambda p: p["level"])).alias("max_level"),
        own_text(F.col("passages")).alias("content"),
    )
    joined = rows.join(threads(linked), ["conv_id", "turn"], "left").join(counts, ["conv_id", "turn"], "left")
    filled = joined.select(
        "conv_id",
        "turn",
        "role",
        F.coalesce("root", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        "parent",
        "n_quotes",
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "max_level",
        "content",
    )
    return numbered(filled, "conv_id", ["thread", "turn", "role", "content"])
