import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lumenfold.llm import structure_repair as sr

SCHEMA = "conv_id long, turn long, role string, text string, key string, alive string, segment string, audit string, code string"
BLANK = " \t\n\x0b\x0c\r"


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", "a", "s", "x", "c") for r in rows], SCHEMA)


def damage(rows):
    """Conversations with their rows after damage, in order; written without the operator's help."""
    out = {}
    for conv, turn, role, text in rows:
        messages = out.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        pick = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        if pick == 0:
            continue
        text = "" if pick == 1 else re.sub("[.!?]", "", text) if pick == 2 else text
        role = "user" if pick == 4 else role
        mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        messages += [(turn is not None, turn or 0, role[:16], mark, turn, role, text)] * (2 if pick == 3 else 1)
    return {c: [m[4:] for m in sorted(ms)] for c, ms in out.items()}


def faults(messages):
    seen, out = set(), []
    for _, role, text in messages:
        body = text.rstrip(BLANK)
        out.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(messages, marks, step, accepting, editable):
    """(cost, audit, edits) by comparing whole strings; ``step`` maps (state, initial) to a state."""
    states = sorted({s for s, _ in step} | set(step.values()))
    best = {s: (0, "", ()) if s in accepting else None for s in states}

    def insert(best):
        for _ in states:
            for s in states:
                for r in editable:
                    after = best.get(step.get((s, r)))
                    if after:
                        new = (after[0] + 3, "I" + after[1], (("I", r), *after[2]))
                        best[s] = min([x for x in (best[s], new) if x], key=lambda x: x[:2])
        return best

    best = insert(best)
    for (_, role, _), fault in zip(reversed(messages), reversed(marks), strict=True):
        now, more = {}, 3 if fault == "t" else 0
        for s in states:
            options = []
            if best[s]:
                options.append((best[s][0] + 4, "D" + best[s][1], (("D", None), *best[s][2])))
            for edit, r, price in [("K", role[:1], 0), *(("R", r, 3) for r in editable)]:
                after = best.get(step.get((s, r)))
                if after and fault not in ("b", "d"):
                    options.append((after[0] + price + more, edit + after[1], ((edit, r), *after[2])))
            now[s] = min(options, key=lambda x: x[:2]) if options else None
        best = insert(now)
    return best[0]


STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def brute(rows):
    out, full = {}, {"u": "user", "a": "assistant"}
    for conv, messages in damage(rows).items():
        marks = faults(messages)
        cost, audit, edits = cheapest(messages, marks, STEP, {0, 3}, "ua")
        lines, rest = [], iter(messages)
        for edit, r in edits:
            message = None if edit == "I" else next(rest)
            if edit != "D":
                lines.append(f"{full[r]}:" if edit == "I" else f"{full[r] if edit == 'R' else message[1]}:{message[2]}")
        turns = {t for t, _, _ in messages if t is not None}
        pairs = zip(messages, messages[1:], strict=False)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(marks.count(m) for m in "bdt"),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def run(spark, rows, **more):
    got = sr.repaired_digests(sr.damaged(table(spark, rows)), alive="alive", **more).collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "User", "", None]
    texts = ["Yes.", "No!", "Well?  \n", "cut off", "", " \t", None, "one. two", "Fine.\n"]
    rows = []
    for conv in [None, *range(conversations)]:
        turn = 0
        for k in range(rng.randrange(longest + 1)):
            turn += rng.choice([0, 1, 1, 1, 1, 3])
            plain = ["user", "assistant"][k % 2] if rng.random() < 0.7 else rng.choice(roles)
            text = f"{rng.choice(texts)}" if rng.random() < 0.5 else f"Message {rng.randrange(9)} of it."
            rows.append((conv, None if rng.random() < 0.05 else turn, plain, text))
    return rows


def test_equals_comparison_of_whole_strings(spark):
    rows = random_rows(1, 400, 9)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("most", [1, 3, 7])
def test_segments_give_the_same(spark, most):
    rows = random_rows(2, 40, 30) + [(999, k % 13, ["user", "assistant"][k // 3 % 2], f"m{k % 40}.") for k in range(120)]
    assert run(spark, rows, most=most) == brute(rows)


def test_one_frequent_message_holds_a_conversation(spark):
    rows = [(1, None, "user", "Same.")] * 50 + [(1, 2, "assistant", "Fine.")]
    assert run(spark, rows, most=8) == brute(rows)


def test_repaired_conversations_fit_the_grammar_and_the_audit(spark):
    rows = random_rows(3, 60, 12)
    lines = {}
    for r in sr.repaired(sr.damaged(table(spark, rows)), alive="alive").orderBy("conv_id", "position").collect():
        if r["position"] is not None:
            assert r["position"] == len(lines.setdefault(r["conv_id"], []))
            lines[r["conv_id"]].append((r["edit"], r["role"], r["text"]))
    assert all(re.fullmatch("(s?(ua)+)?", "".join(role[:1] for _, role, _ in x)) for x in lines.values())
    assert all(text == "" for x in lines.values() for edit, _, text in x if edit == "I")


def test_ranks_decide_where_initials_tie(spark):
    """Two roles can be inserted at the start, so equal initials lead to different states."""
    grammar = sr.Grammar(
        roles=("user", "assistant", "system"),
        step=((1, 2, None), (None, 3, None), (4, None, 5), (1, None, None), (None, 2, None), (None, None, 0)),
        accepting=(0, 3, 4),
    )
    step = {(s, "uas"[r]): t for s, row in enumerate(grammar.step) for r, t in enumerate(row) if t is not None}
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool"]), f"{c}-{t}.") for c in range(150) for t in range(rng.randrange(14))]
    for most in (100, 4):
        audits = {r["conv_id"]: (r["cost"], r["audit"]) for r in sr.repaired_digests(table(spark, rows), grammar, most).collect()}
        for conv in {r[0] for r in rows}:
            messages = [r[1:] for r in rows if r[0] == conv]
            assert audits[conv] == cheapest(messages, faults(messages), step, {0, 3, 4}, "ua")[:2]


def test_dropped_conversations_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, [(gone, 0, "user", "Hi.")])[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert run(spark, []) == {}


def test_long_text_and_string_ids(spark):
    rows = [("a:b", 1, "user", "long text " * 200_000 + "."), ("a:b", 2, "assistant", "ok."), ("", 1, "system", "only.")]
    got = sr.repaired_digests(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).collect()
    lines = f"user:{rows[0][3]}\nassistant:ok."
    assert {r["conv_id"]: (r["audit"], r["cost"]) for r in got} == {"a:b": ("KK", 0), "": ("D", 4)}
    assert hashlib.sha256(lines.encode()).hexdigest() in {r["repaired_sha256"] for r in got}


def test_damage_keeps_every_conversation(spark):
    rows = random_rows(4, 30, 5)
    got = sr.damaged(table(spark, rows)).select(F.countDistinct(F.coalesce("conv_id", F.lit(-1)))).first()[0]
    assert got == len({r[0] for r in rows})
