"""Cheapest repair of the role structure of conversations, with the least audit among equal costs.

The messages of a conversation, in the order of their turns, are edited so that their roles are accepted by a ``Grammar``
(by default an optional system message and then pairs of user and assistant). Edits are Keep (0), Rerole (3), Delete (4) and
Insert of an empty message (3); blank and duplicate messages must be deleted, a truncated one that stays adds 3.

*Cost.* A node is (message, state of the grammar). A backward pass finds the least cost from each node to the end, and with
it the optimal arcs. *Audit.* Nodes are ranked by the least string of 2^k edit initials along optimal arcs, k = 0, 1, ...
A node of the next length is ranked by its own rank and the least rank among the nodes its paths lead to; those
with that rank are its pointers, which so double their length. At last the path is read from the pointers: the middle
of a path of 2^k arcs is a pointer of half the length with the least rank, and so on down to single arcs.

Only a few bytes per message are gathered for that: initial, faults, and a digest for duplicates. Conversations with more
than ``SEGMENT`` messages are cut into segments of that many by a range sort. Segments give cost matrices between states, from
which each gets the costs at its end, and then ranks and pointers of its first nodes, from which each gets its
first and last state. The task that combines them holds about a hundred bytes per segment.
Whole texts are shuffled once, in sorted order, and pass through a task message by message, because the hash of a
conversation is sequential; the audit, one byte per message, is the only thing held of a conversation.

Order within a turn: nulls first; equal turns by the first 16 characters of the role, then by a digest of role and text.
Null roles and texts are one space; a null conversation is one of its own, null turns don't count for gaps. Repeated rows are
duplicates. Extra columns are ignored; an empty table gives an empty result. A gap beyond the range of long is cut to its end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type

from lumenfold.plans.skew import salted_join
from lumenfold.plans.stage import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
INITIALS = "DIKR"
SEGMENT = 65_536
NODES = 1 << 20
OUT_ROWS = 1024
FAR = 1 << 60
LONG = (1 << 63) - 1
BLANKS = " \t\n\x0b\x0c\r"
# Bits of a message's code beside its role: it must go, it is truncated, it is blank.
MUST, CUT, EMPTY = 4, 8, 16
EVERY = 20


@dataclass(frozen=True)
class Grammar:
    """States and the roles that lead from one to the next (None: not allowed). State 0 is the first.

    There are at most three, told by their initials. The first ``editable`` roles can be inserted and given to a message.
    """

    roles: tuple[str, ...] = ("user", "assistant", "system")
    step: tuple[tuple[int | None, ...], ...] = ((2, None, 1), (2, None, None), (None, 3, None), (2, None, None))
    accepting: tuple[int, ...] = (0, 3)
    editable: int = 2

    def table(self) -> np.ndarray:
        """``step`` as numbers, -1 where it leads nowhere, with a last column for all other roles."""
        return np.array([[-1 if t is None else t for t in row] + [-1] for row in self.step])

    def ends(self) -> np.ndarray:
        """The cost of ending in each state, insertions included."""
        cost = np.full(len(self.step), FAR)
        cost[list(self.accepting)] = 0
        return with_inserts(cost[None], self.table(), self.editable)[0]


GRAMMAR = Grammar()


def with_inserts(cost: np.ndarray, step: np.ndarray, editable: int) -> np.ndarray:
    for _ in range(len(step)):
        for r in range(editable):
            there = np.where(step[:, r] >= 0, cost[:, step[:, r]], FAR)
            cost = np.minimum(cost, there + INSERT)
    return cost


def padded(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lens = np.array([len(c) for c in codes], np.int64)
    out = np.zeros((len(codes), int(lens.max(initial=0))), np.uint8)
    out[np.arange(out.shape[1]) < lens[:, None]] = np.frombuffer(b"".join(codes), np.uint8)
    return out, lens


def edit_costs(code: np.ndarray, roles: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(role, cost of truncation, whether it must go) of messages."""
    role = np.minimum(code & 3, roles)
    return role, np.where(code & CUT, TRUNCATED, 0), (code & MUST) > 0


def costs_to_go(codes: np.ndarray, lens: np.ndarray, finals: np.ndarray, grammar: Grammar) -> np.ndarray:
    """Least cost from (message, state) to the end; ``lens`` descending, ``finals`` the costs at the end."""
    step, n = grammar.table(), codes.shape[1]
    cost = np.full((len(lens), n + 1, len(step)), FAR)
    cost[np.arange(len(lens)), lens] = finals
    for i in range(n - 1, -1, -1):
        live = int((lens > i).sum())
        if not live:
            continue
        after = cost[:live, i + 1]
        role, cut, must = edit_costs(codes[:live, i], len(grammar.roles))
        best = after + DELETE
        stays = np.where(must, FAR, cut)[:, None]
        to = step[:, role].T
        kept = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0), 1), FAR)
        best = np.minimum(best, kept + stays + KEEP)
        for r in range(grammar.editable):
            there = np.where(step[:, r] >= 0, after[:, step[:, r]], FAR)
            best = np.minimum(best, there + stays + REROLE)
        cost[:live, i] = np.minimum(with_inserts(best, step, grammar.editable), FAR)
    return cost


def optimal_arcs(codes: np.ndarray, lens: np.ndarray, cost: np.ndarray, last: np.ndarray, grammar: Grammar):
    """(label, next row, mask of next states) of the least-labelled optimal arcs of every node.

    Rows of a conversation are its messages, its end and a sink. Label 0 leads to the sink and stays there;
    the others are the places of the edits in ``INITIALS``, from 1.
    """
    step, (g, n) = grammar.table(), codes.shape
    states, width = len(step), n + 2
    label = np.zeros((g, width, states), np.int64)
    at = np.arange(g)[:, None] * width + np.arange(width)[None, :]
    sink = np.arange(g) * width + lens + 1
    row = np.broadcast_to(sink[:, None, None], label.shape).copy()
    mask = np.broadcast_to(1 << np.arange(states), label.shape).copy()
    here = np.concatenate([cost, np.full((g, 1, states), FAR)], axis=1)
    after = np.concatenate([here[:, 1:], np.full((g, 1, states), FAR)], axis=1)
    message = (np.arange(width) < lens[:, None])[:, :, None] & (here < FAR)
    role, cut, must = edit_costs(np.pad(codes, ((0, 0), (0, 2))), len(grammar.roles))
    stays = np.where(must, FAR, cut)[:, :, None]
    to = step[:, role].transpose(1, 2, 0)
    kept = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0), 2), FAR)

    def found(which: np.ndarray, edit: str, moves: int, targets: np.ndarray) -> None:
        label[which], mask[which] = INITIALS.index(edit) + 1, targets[which]
        row[which] = np.broadcast_to(at[:, :, None] + moves, row.shape)[which]

    def to_role(costs: np.ndarray, price, where: np.ndarray) -> np.ndarray:
        targets = np.zeros(label.shape, np.int64)
        for r in range(grammar.editable):
            there = np.where(step[:, r] >= 0, costs[:, :, step[:, r]], FAR)
            targets |= np.where(where & (here == there + price), 1 << np.maximum(step[:, r], 0), 0)
        return targets

    # From the greatest label to the least, so that the least one stays.
    reroled = to_role(after, stays + REROLE, message)
    found(reroled > 0, "R", 1, reroled)
    found(message & (here == kept + stays + KEEP), "K", 1, 1 << np.maximum(to, 0))
    open_end = (np.arange(width) == lens[:, None])[:, :, None] & last[:, None, None] & (here < FAR)
    inserted = to_role(here, INSERT, message | open_end)
    found(inserted > 0, "I", 0, inserted)
    found(message & (here == after + DELETE), "D", 1, np.broadcast_to(1 << np.arange(states), label.shape))
    return label.reshape(-1), row.reshape(-1), mask.reshape(-1)


def path_ranks(label: np.ndarray, row: np.ndarray, mask: np.ndarray, states: int, sinks: np.ndarray):
    """[(row, mask, rank)] for paths of 1, 2, 4, ... arcs, until every path has ended in one of the rows ``sinks``."""
    levels = [(row, mask, label)]
    while True:
        row, mask, rank = levels[-1]
        if np.isin(row, sinks, kind="table").all():
            return levels
        ranks = np.stack([np.where(mask >> s & 1, rank[row * states + s], np.iinfo(np.int64).max) for s in range(states)])
        least = ranks.min(axis=0)
        new_mask, new_row = np.zeros_like(mask), row.copy()
        for s in range(states):
            best = (ranks[s] == least) & (mask >> s & 1 > 0)
            new_mask[best] |= mask[row[best] * states + s]
            new_row[best] = row[row[best] * states + s]
        together = rank * (int(rank.max()) + 1) + least
        levels.append((new_row, new_mask, np.unique(together, return_inverse=True)[1].astype(np.int64)))


def read_paths(levels: list, states: int, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, next states) along the least path from each start; ``ends`` are the states in the sink."""
    nodes, goals = starts[:, None], ends[:, None]
    for row, mask, rank in reversed(levels[:-1]):
        there, bits = row[nodes], mask[nodes]
        ranks = np.stack([np.where(bits >> s & 1, rank[there * states + s], np.iinfo(np.int64).max) for s in range(states)])
        least = ranks.min(axis=0)
        reach = np.stack([mask[there * states + s] >> goals & 1 for s in range(states)])
        middle = np.argmax((ranks == least) & (reach > 0), axis=0)
        nodes = np.stack([nodes, there * states + middle], axis=2).reshape(len(starts), -1)
        goals = np.stack([middle, goals], axis=2).reshape(len(starts), -1)
    return nodes, goals


@dataclass
class Ranked:
    """Costs, labels and ranked pointers of segments of similar length, ordered by length, longest first."""

    cost: np.ndarray
    label: np.ndarray
    levels: list
    width: int


def ranked(codes: list[bytes], finals: np.ndarray, last: np.ndarray, grammar: Grammar) -> Ranked:
    cells, lens = padded(codes)
    cost = costs_to_go(cells, lens, finals, grammar)
    label, row, mask = optimal_arcs(cells, lens, cost, last, grammar)
    states, width = finals.shape[1], cells.shape[1] + 2
    sinks = np.arange(len(lens)) * width + lens + 1
    return Ranked(cost, label, path_ranks(label, row, mask, states, sinks), width)


def batches_of(codes: list[bytes], states: int) -> Iterator[list[int]]:
    """Places of segments of similar length, longest first, so that a batch has about ``NODES`` nodes."""
    order = sorted(range(len(codes)), key=lambda i: -len(codes[i]))
    at = 0
    while at < len(order):
        top = len(codes[order[at]])
        end, most = at, max(1, NODES // ((top + 2) * states))
        while end < len(order) and end - at < most and 2 * len(codes[order[end]]) >= top:
            end += 1
        yield order[at:end]
        at = end


def least_paths(codes: list[bytes], starts: list[int], ends: list[int], finals: list, last: list[bool], grammar: Grammar):
    """(audit, roles, cost) of each segment: edit initials, the role of each Rerole and Insert (else a dot)."""
    step, out = grammar.table(), [("", "", 0)] * len(codes)
    states = len(step)
    role_of = np.full((states, states), ord("."), np.uint8)
    for r in range(grammar.editable - 1, -1, -1):
        for s in range(states):
            if step[s, r] >= 0:
                role_of[s, step[s, r]] = ord("0") + r
    letters = np.frombuffer(b"\0" + INITIALS.encode(), np.uint8)
    for part in batches_of(codes, states):
        solved = ranked([codes[i] for i in part], np.array([finals[i] for i in part]), np.array([last[i] for i in part]), grammar)
        first = np.array([starts[i] for i in part])
        nodes = np.arange(len(part)) * solved.width * states + first
        reached = solved.levels[-1][1][nodes]
        goals = np.array([ends[i] if ends[i] >= 0 else (int(m) & -int(m)).bit_length() - 1 for i, m in zip(part, reached, strict=True)])
        path, to = read_paths(solved.levels, states, nodes, goals)
        labels = solved.label[path]
        edits = letters[labels]
        roles = np.where((labels == INITIALS.index("I") + 1) | (labels == INITIALS.index("R") + 1), role_of[path % states, to], ord("."))
        for k, i in enumerate(part):
            there = labels[k] > 0
            out[i] = (
                edits[k][there].tobytes().decode(),
                roles[k][there].astype(np.uint8).tobytes().decode(),
                int(solved.cost[k, 0, first[k]]),
            )
    return out


def initials(role: Column, grammar: Grammar) -> Column:
    code = F.lit(len(grammar.roles))
    for r, name in enumerate(grammar.roles):
        code = F.when(F.left(role, F.lit(1)) == name[0], F.lit(r)).otherwise(code)
    return code


def keyed(messages: DataFrame, alive: str | None) -> DataFrame:
    """Messages with a key that is never null and the columns that order them."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    name = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    return messages.select(
        F.unhex(F.md5(name)).alias("key"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.left(role, F.lit(16)).alias("role_start"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        role.alias("role"),
        text.alias("text"),
        (F.col(alive) if alive else F.lit(True)).alias("alive"),
    )


ORDER = ["turn", "role_start", "digest"]


def coded(rows: DataFrame, grammar: Grammar) -> DataFrame:
    """The few bytes of each message that decide its edits."""
    stripped = F.rtrim("text", F.lit(BLANKS))
    cut = ~(stripped.endswith(".") | stripped.endswith("!") | stripped.endswith("?"))
    faults = F.when(stripped == "", F.lit(MUST + EMPTY)).when(cut, F.lit(CUT)).otherwise(F.lit(0))
    code = (initials(F.col("role"), grammar) + faults).cast("int")
    return rows.select("key", "conv_id", *ORDER, F.when(F.col("alive"), code).alias("code"))


def segmented(rows: DataFrame, most: int) -> DataFrame:
    """Add ``segment`` (from 0), ``split`` (whether the conversation has several) and ``opener``.

    For split conversations there are further rows with ``opener``: the digests that occur first in that segment.
    """
    counts = stage(rows.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > most), "long-conversations")
    whole = rows.withColumns({"segment": F.lit(0).cast("long"), "split": F.lit(False), "opener": F.lit(False)})
    if counts.isEmpty():
        return whole
    marked = salted_join(rows, counts.select("key", F.lit(True).alias("long")), "key", counts, ["digest", "turn"], "left")
    marked = stage(marked, "marked-messages")
    # The number parts equal messages; it is read from a written table, so a repeated task gives it again.
    long = marked.where("long").drop("long").withColumn("_tie", F.monotonically_increasing_id())
    ranged = long.repartitionByRange("key", *ORDER, "_tie").sortWithinPartitions("key", *ORDER).drop("_tie")
    sorted_rows = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "sorted-messages")
    part = F.shiftright("_at", 33)
    tally = sorted_rows.groupBy("key", part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_low"))
    before = F.sum("_n").over(W.partitionBy("key").orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    begins = stage(tally.select("key", "_part", "_low", F.coalesce(before, F.lit(0)).alias("_begin")), "segment-begins")
    numbered = sorted_rows.withColumn("_part", part).join(begins, ["key", "_part"])
    place = F.col("_begin") + F.col("_at") - F.col("_low")
    segment = ((place - place % most) / most).cast("long")
    cut = numbered.withColumns(
        {"segment": segment, "split": F.lit(True), "opener": F.lit(False)}
    ).drop("_at", "_part", "_low", "_begin")
    firsts = cut.where("code IS NOT NULL").groupBy("key", "digest").agg(F.min("segment").alias("segment"))
    openers = firsts.withColumns({"split": F.lit(True), "opener": F.lit(True)})
    short = marked.where("long IS NULL").drop("long").withColumns({"segment": F.lit(0).cast("long"), "split": F.lit(False), "opener": F.lit(False)})
    return short.unionByName(cut).unionByName(openers, allowMissingColumns=True)


STATS = "blank duplicate truncated illegal turns first_turn last_turn first_role last_role".split()


def segment_codes(rows: DataFrame, grammar: Grammar, most: int) -> DataFrame:
    """(key, conv_id, segment, split, codes, stats) of every segment; ``codes`` has a byte per message."""
    conv = rows.schema["conv_id"].dataType
    legal = legal_pairs(grammar)

    def summary(conv_id, segment, split, messages) -> tuple:
        openers, seen, codes, illegal = set(), set(), bytearray(), 0
        blank = duplicate = truncated = turns = 0
        first = last = None
        for turn, mark, code, opener in messages:
            if opener:
                openers.add(mark)
                continue
            if code is None:
                continue
            if code & EMPTY:
                blank += 1
                code &= 3 | MUST
            elif mark in seen or (split and mark not in openers):
                duplicate += 1
                code = code & 3 | MUST
            elif code & CUT:
                truncated += 1
            seen.add(mark)
            illegal += bool(codes) and (codes[-1] & 3, code & 3) not in legal
            codes.append(code)
            if turn is not None:
                turns += turn != last
                first, last = turn if first is None else first, turn
        ends = (codes[0] & 3, codes[-1] & 3) if codes else (None, None)
        return conv_id, segment, split, bytes(codes), [blank, duplicate, truncated, illegal, turns, first, last, *ends]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, [], []
        for batch in batches:
            names = ("key", "segment", "conv_id", "split", "turn", "digest", "code", "opener")
            for key, segment, conv_id, split, *message in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if now is None or now[:2] != (key, segment):
                    if now is not None:
                        out.append((now[0], *summary(now[2], now[1], now[3], held)))
                    now, held = (key, segment, conv_id, split), []
                elif now[2] is None and conv_id is not None:
                    now = (key, segment, conv_id, split)
                held.append(message)
            yield table(out)
            out = []
        if now is not None:
            yield table([(now[0], *summary(now[2], now[1], now[3], held))])

    def table(out: list) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=heads)

    heads = ["key", "conv_id", "segment", "split", "codes", "stats"]
    kinds = [pa.binary(), to_arrow_type(conv), pa.int64(), pa.bool_(), pa.binary(), pa.list_(pa.int64())]
    placed = segmented(rows, most).repartition("key", "segment").sortWithinPartitions("key", "segment", F.desc("opener"), *ORDER)
    return placed.mapInArrow(run, f"key binary, conv_id {conv.simpleString()}, segment long, split boolean, codes binary, stats array<long>")


def legal_pairs(grammar: Grammar) -> set[tuple[int, int]]:
    """Roles that may follow each other."""
    pairs = set()
    for row in grammar.step:
        for r, to in enumerate(row):
            if to is not None:
                pairs |= {(r, q) for q, then in enumerate(grammar.step[to]) if then is not None}
    return pairs


def joined_segments(segments: DataFrame, grammar: Grammar) -> DataFrame:
    """(key, segment, start, end, finals) of the segments of split conversations."""
    split = segments.where("split").select("key", "segment", "codes")
    states = len(grammar.step)

    def matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for codes in frame["codes"]:
                cells, lens = padded([bytes(codes)] * states)
                cost = costs_to_go(cells, lens, np.where(np.eye(states) > 0, 0, FAR), grammar)
                out.append(cost[:, 0].reshape(-1).tolist())
            yield frame[["key", "segment"]].assign(matrix=out)

    def backward(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("segment", ignore_index=True)
        out, finals = [], grammar.ends()
        for matrix in frame["matrix"][::-1]:
            out.append(finals.tolist())
            finals = np.minimum((np.asarray(matrix).reshape(states, states) + finals[:, None]).min(axis=0), FAR)
        return frame[["key", "segment"]].assign(finals=out[::-1], last=[False] * (len(out) - 1) + [True])

    def first_ranks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for codes, finals, last in zip(frame["codes"], frame["finals"], frame["last"], strict=True):
                row, mask, rank = ranked([bytes(codes)], np.array([finals]), np.array([last]), grammar).levels[-1]
                out.append((rank[:states].tolist(), mask[:states].tolist()))
            yield frame[["key", "segment", "finals", "last"]].assign(ranks=[r for r, _ in out], masks=[m for _, m in out])

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("segment", ignore_index=True)
        reach, lives = {0}, []
        for ranks, masks in zip(frame["ranks"], frame["masks"], strict=True):
            least = min(ranks[s] for s in reach)
            lives.append({s for s in reach if ranks[s] == least})
            reach = {t for s in lives[-1] for t in range(states) if int(masks[s]) >> t & 1}
        end, rows = min(reach), []
        for live, masks in zip(reversed(lives), frame["masks"][::-1], strict=True):
            start = min(s for s in live if int(masks[s]) >> end & 1)
            rows.append((start, end))
            end = start
        rows.reverse()
        return frame[["key", "segment", "finals", "last"]].assign(start=[a for a, _ in rows], end=[b for _, b in rows])

    costs = split.mapInPandas(matrices, "key binary, segment long, matrix array<long>")
    finals = costs.groupBy("key").applyInPandas(backward, "key binary, segment long, finals array<long>, last boolean")
    ranks = split.join(finals, ["key", "segment"]).mapInPandas(
        first_ranks, "key binary, segment long, finals array<long>, last boolean, ranks array<long>, masks array<long>"
    )
    chosen = "key binary, segment long, finals array<long>, last boolean, start int, end int"
    return stage(ranks.groupBy("key").applyInPandas(choose, chosen), "segment-states")


def audits(messages: DataFrame, grammar: Grammar = GRAMMAR, most: int = SEGMENT) -> DataFrame:
    """(key, conv_id, segment, audit, roles, cost, stats) of every segment of keyed messages.

    The stats are those named in ``STATS``; the cost of segment 0 is that of its conversation.
    """
    segments = stage(segment_codes(coded(messages, grammar), grammar, most), "segments")
    if segments.where("split").isEmpty():
        nothing = {"start": "int", "end": "int", "finals": "array<long>", "last": "boolean"}
        given = segments.withColumns({n: F.lit(None).cast(t) for n, t in nothing.items()})
    else:
        given = segments.join(joined_segments(segments, grammar), ["key", "segment"], "left")
    ends = grammar.ends().tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, starts, goals, finals, last = (batch.column(c).to_pylist() for c in ("codes", "start", "end", "finals", "last"))
            found = least_paths(
                codes,
                [s or 0 for s in starts],
                [-1 if e is None else e for e in goals],
                [f or ends for f in finals],
                [x is not False for x in last],
                grammar,
            )
            columns = zip(*found, strict=True) if found else [[]] * 3
            kinds = [pa.string(), pa.string(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "conv_id", "segment", "stats")), *arrays], names=names)

    names = ["key", "conv_id", "segment", "stats", "audit", "roles", "cost"]
    kind = messages.schema["conv_id"].dataType.simpleString()
    schema = f"key binary, conv_id {kind}, segment long, stats array<long>, audit string, roles string, cost long"
    return given.mapInArrow(run, schema)


@dataclass
class Conversation:
    """What the segments of one conversation say, put together."""

    conv_id: object
    audit: str
    roles: str
    cost: int
    stats: dict

    @classmethod
    def of(cls, segments: list[dict], legal: set) -> Conversation:
        total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        first = last = role = None
        for s in segments:
            stats = dict(zip(STATS, s["stats"], strict=True))
            for name in total:
                total[name] += stats[name]
            if stats["first_role"] is not None:
                total["illegal"] += role is not None and (role, stats["first_role"]) not in legal
                role = stats["last_role"]
            if stats["first_turn"] is not None:
                total["turns"] -= last is not None and last == stats["first_turn"]
                first, last = stats["first_turn"] if first is None else first, stats["last_turn"]
        total["gaps"] = 0 if first is None else min(last - first + 1 - total["turns"], LONG)
        audit, roles = ("".join(s[c] for s in segments) for c in ("audit", "roles"))
        return cls(segments[0]["conv_id"], audit, roles, segments[0]["cost"], total)


class Rows:
    """The rows of a task, one by one, with a look at the next."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.rows = (row for batch in batches for row in batch.to_pylist())
        self.ahead = next(self.rows, None)

    def take(self) -> dict:
        row, self.ahead = self.ahead, next(self.rows, None)
        return row

    def segments(self) -> list[dict]:
        """The rows of segments that begin a conversation."""
        found = [self.take()]
        while self.ahead is not None and self.ahead["key"] == found[0]["key"] and self.ahead["segment"] is not None:
            found.append(self.take())
        return found


def walked(messages: DataFrame, grammar: Grammar, most: int, fields: dict[str, str], visit) -> DataFrame:
    """Apply ``visit(conversation, edits)`` to every conversation; it yields rows of conv_id and ``fields``.

    ``edits`` is an iterator of (edit, role, text), in order; deleted messages keep their role and text.
    """
    conv = messages.schema["conv_id"].dataType
    head = audits(messages, grammar, most).withColumns({"turn": F.lit(None).cast("long"), "role_start": F.lit(None).cast("string")})
    body = messages.where("alive").select("key", *ORDER, "role", "text")
    both = head.unionByName(body, allowMissingColumns=True)
    ordered = both.repartition("key").sortWithinPartitions("key", F.asc_nulls_last("segment"), *ORDER)
    legal, names = legal_pairs(grammar), list(grammar.roles)
    heads = ["conv_id", *fields]
    kinds = [to_arrow_type(conv), *({"long": pa.int64(), "string": pa.string()}[t] for t in fields.values())]

    def edits(conversation: Conversation, rows: Rows) -> Iterator[tuple]:
        for edit, role in zip(conversation.audit, conversation.roles, strict=True):
            if edit == "I":
                yield edit, names[int(role)], ""
            else:
                message = rows.take()
                yield edit, names[int(role)] if edit == "R" else message["role"], message["text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, out = Rows(batches), []
        while rows.ahead is not None:
            conversation = Conversation.of(rows.segments(), legal)
            for row in visit(conversation, edits(conversation, rows)):
                out.append(row)
                if len(out) >= OUT_ROWS:
                    yield table(out)
                    out = []
        yield table(out)

    def table(out: list) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=heads)

    return ordered.mapInArrow(run, ", ".join([f"conv_id {conv.simpleString()}", *(f"{n} {t}" for n, t in fields.items())]))


def repaired(messages: DataFrame, grammar: Grammar = GRAMMAR, most: int = SEGMENT, alive: str | None = None) -> DataFrame:
    """The messages after repair: conv_id, position, edit, role, text. Deleted ones have no position."""

    def visit(conversation: Conversation, edits: Iterator[tuple]) -> Iterator[tuple]:
        at = 0
        for edit, role, text in edits:
            yield conversation.conv_id, None if edit == "D" else at, edit, role, text
            at += edit != "D"

    fields = {"position": "long", "edit": "string", "role": "string", "text": "string"}
    return walked(keyed(messages, alive), grammar, most, fields, visit)


def repaired_digests(messages: DataFrame, grammar: Grammar = GRAMMAR, most: int = SEGMENT, alive: str | None = None) -> DataFrame:
    """Per conversation: its faults, cost and audit, and the SHA-256 of its repaired ``role:text`` lines."""

    def visit(conversation: Conversation, edits: Iterator[tuple]) -> Iterator[tuple]:
        mark, first = hashlib.sha256(), True
        for edit, role, text in edits:
            if edit != "D":
                mark.update(f"{role}:{text}".encode() if first else f"\n{role}:{text}".encode())
                first = False
        s = conversation.stats
        counts = (s["gaps"], s["blank"], s["duplicate"], s["truncated"], s["illegal"])
        yield conversation.conv_id, *counts, conversation.cost, conversation.audit, mark.hexdigest()

    fields = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), "long")
    return walked(keyed(messages, alive), grammar, most, fields | {"audit": "string", "repaired_sha256": "string"}, visit)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults that a hash of conversation and turn chooses; ``alive`` is false for dropped ones."""
    blank = F.lit(" ")
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    pick = F.crc32(name) % EVERY
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
    worse = F.when(pick == 1, F.lit("")).when(pick == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(pick == 4, F.lit("user")).otherwise(role).alias("role"),
        worse.alias("text"),
        (pick != 0).alias("alive"),
        F.explode(F.when(pick == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")
