import hashlib
import random
import re

from lumenfold.llm import quote_links

SCHEMA = "conv_id long, turn long, role string, text string, position string, parent string"
MESSAGES = [
    (1, 0, "u", "Hello big wide world\nsecond line of it"),
    (1, 1, "a", "My answer goes here"),
    (1, 2, "u", "> My ANSWER goes here!\r\nNo it does not work"),
    (1, 3, "a", ">> My answer goes here\n> No it does not work\nwell ok then it is"),
    (1, 4, "u", " > hello big wide world\nyes yes yes"),
    (2, 0, "u", "> second line of it\nfrom elsewhere"),
    (2, 0, None, None),
    (2, 1, "u", "> too short\n> > > deep quoted words here"),
    (3, 0, "a", "deep quoted words here"),
    (None, 1, "u", "> second line of it"),
    (2, None, "u", "zzz"),
]


def run(spark, messages):
    return quote_links.reply_ordered(spark.createDataFrame([(*m, "p", "q") for m in messages], SCHEMA))


def passages(text):
    out = []
    for line in re.split(r"\r?\n", text or ""):
        marks = re.match(r"[ \t]*((?:>[ \t]*)+)", line)
        level = marks[1].count(">") if marks else 0
        body = line[marks.end() :] if marks else line
        if out and out[-1][0] == level:
            out[-1][1].append(body)
        else:
            out.append((level, [body]))
    return [(level, "\n".join(b)) for level, b in out]


def name(text):
    plain = re.sub(r"[\W_]+", " ", text.lower()).strip(" ")
    return hashlib.md5(plain.encode()).digest() if len(plain.split(" ")) >= quote_links.LEAST_WORDS else None


def brute_links(messages):
    own = []
    for c, t, _, text in messages:
        if c is None or t is None:
            continue
        parts = [b for level, b in passages(text) if level == 0]
        whole = "\n".join(parts).strip(" ")
        own += [(c, t, name(x)) for x in [whole, *parts, *re.split(r"\n[ \t]*\n", whole), *whole.split("\n")]]
    out = set()
    for c, t, _, text in messages:
        if c is None or t is None:
            continue
        for nth, (level, body) in enumerate(passages(text)):
            h = name(body)
            if not level or h is None:
                continue
            inside = [u for d, u, k in own if k == h and d == c]
            outside = [(d, u) for d, u, k in own if k == h and d != c]
            target = (c, min(inside)) if inside and min(inside) < t else min(outside, default=(None, None))
            out.add((c, t, level, nth, *target))
    return out


def linked(spark, messages):
    frame = spark.createDataFrame([(*m, "p", "q") for m in messages], SCHEMA)
    rows = quote_links.links(quote_links.with_passages(frame)).drop("hash").collect()
    return {tuple(r) for r in rows}


def test_links_equal_brute_force(spark):
    rng = random.Random(4)
    said = ["the red fox ran", "over a hill", "into deep woods today", "no reply at all", "short"]
    made = []
    for c in range(8):
        for t in range(6):
            lines = [rng.choice(["", "", "> ", ">> ", "> >> "]) + rng.choice(said) for _ in range(rng.randrange(1, 5))]
            made.append((c, t, "u", "\n".join(lines)))
    for messages in (MESSAGES, made):
        assert linked(spark, messages) == brute_links(messages)


def test_reply_order(spark):
    rows = run(spark, MESSAGES).collect()
    first = sorted((r for r in rows if r["conv_id"] == 1), key=lambda r: r["position"])
    assert [r["turn"] for r in first] == [0, 4, 1, 2, 3]
    assert [r["depth"] for r in first] == [0, 1, 0, 1, 2]
    assert [r["content"] for r in first][1:] == ["yes yes yes", "My answer goes here", "No it does not work", "well ok then it is"]
    assert [r["parent"] for r in first] == [None, 0, None, 1, 2]
    assert len(rows) == len(MESSAGES)
    assert [r["position"] for r in rows if r["conv_id"] is None] == [None]
    assert sorted(r["position"] for r in rows if r["conv_id"] == 2) == [0, 1, 2, 3]


def test_long_threads_and_empty_table(spark):
    chain = [(1, 0, "u", "message number 0 of many")] + [(1, t, "u", f"> message number {t - 1} of many\nmessage number {t} of many") for t in range(1, 40)]
    rows = sorted(run(spark, chain).collect(), key=lambda r: r["position"])
    assert [r["depth"] for r in rows] == list(range(40)) and {r["thread"] for r in rows} == {0}
    assert run(spark, []).count() == 0


def test_short_and_unspaced_quotes(spark):
    said = "今日はとても良い天気ですね"
    messages = [
        (1, 0, "u", "yes please"),
        (1, 1, "a", "something else"),
        (1, 2, "u", "> Yes, please\nsorted then"),
        (1, 3, "u", f"{said}。"),
        (1, 4, "a", f"> {said}\nはい"),
        (2, 0, "u", f"> {said}\n> > yes please\n> ?!\nwhat"),
    ]
    rows = {(r["conv_id"], r["turn"]): r for r in run(spark, messages).collect()}
    assert rows[1, 2]["parent"] == 0 and rows[1, 4]["parent"] == 3
    # Short passages of other conversations are no originals; long ones are, without blanks as well.
    assert [rows[2, 0][k] for k in ("n_quotes", "n_linked", "parent")] == [3, 1, None]


def test_parts_of_paragraphs_and_rewrapped_sentences(spark):
    original = "The first line is here.\nA second line follows it.\nThen the third one comes.\nAnd the last line ends."
    messages = [
        (1, 0, "u", original),
        (1, 1, "a", "The first line is here.\nA second line follows it."),
        (1, 2, "u", "> A second line follows it.\n> Then the third one comes.\nmiddle lines"),
        (1, 3, "u", "> A second line follows\n> it. Then the third\n> one comes.\nwrapped anew"),
        (1, 4, "u", "> Then the third one comes.\n> A second line follows it.\nout of order"),
        (1, 5, "u", "> Then the third one comes.\n> Something else altogether.\nhalf known"),
        (1, 6, "u", "> And the last line ends.\none line"),
        (2, 0, "u", "> A second line follows it.\n> Then the third one comes.\nanother conversation"),
        (1, 7, "u", "> A second line follows it.\n> Then the third one comes.\n>> And the last line ends.\n> The first line is here.\n> A second line follows it.\nthree quotes"),
    ]
    rows = {(r["conv_id"], r["turn"]): r for r in run(spark, messages).collect()}
    assert [rows[1, t]["parent"] for t in (2, 3, 4, 5, 6)] == [0, 0, None, None, 0]
    assert rows[2, 0]["n_linked"] == 0 and rows[1, 7]["n_linked"] == 3
    at = sorted((r["position"], r["turn"]) for r in rows.values() if r["conv_id"] == 1)
    assert [t for _, t in at].index(2) > [t for _, t in at].index(0)


def brute_part(messages, conv, turn, body):
    """The message where the last pair of units first appears, if it holds all of them."""
    plain = lambda x: re.sub(r"[\W_]+", " ", x.lower()).strip(" ")
    kinds = [lambda b: b.split("\n"), lambda b: re.split(r"(?<=[.!?])\s*(?=\S)", re.sub(r"[ \t]*\n[ \t]*", " ", b))]
    best = []
    for units in kinds:
        mine = [plain(u) for u in units(body) if plain(u)]
        need = {(a, b) for a, b in zip(mine, mine[1:], strict=False)} or {(u,) for u in mine}
        held = {}
        for c, t, _, text in messages:
            if c == conv and t is not None:
                own = "\n".join(b for level, b in passages(text) if level == 0).strip(" ")
                for every in kinds:
                    u = [plain(x) for x in every(own) if plain(x)]
                    held.setdefault(t, set()).update([(x,) for x in u], zip(u, u[1:], strict=False))
        firsts = [min((t for t, h in held.items() if n in h), default=None) for n in need]
        if need and None not in firsts and max(firsts) < turn and need <= held[max(firsts)]:
            best.append(max(firsts))
    return min(best, default=None)


def test_part_links_equal_brute_force(spark):
    rng = random.Random(6)
    said = ["the red fox ran.", "over a hill it went", "into deep woods today!", "no reply at all?", "short", "and so on", "that is it."]
    made = []
    for c in range(10):
        for t in range(7):
            marks = ["", "", "", ""] if t < 3 else ["", "> ", "> ", ">> "]
            at = [rng.randrange(len(said)) for _ in range(4)]
            lines = [f"{rng.choice(marks)}{said[(k + j) % 7]} {c}" for k in at[:2] for j in range(rng.randrange(1, 4))]
            made.append((c, t, "u", "\n".join(lines)))
    messages = quote_links.with_passages(spark.createDataFrame([(*m, "p", "q") for m in made], SCHEMA))
    whole = quote_links.links(messages, short=True)
    before = {tuple(r)[:4]: tuple(r)[5:] for r in whole.collect()}
    after = {tuple(r)[:4]: tuple(r)[5:] for r in quote_links.part_links(messages, whole).collect()}
    texts = {(c, t): passages(text) for c, t, _, text in made}
    new = 0
    for (c, t, level, nth), target in before.items():
        want = target
        if target[0] is None and (part := brute_part(made, c, t, texts[c, t][nth][1])) is not None:
            want, new = (c, part), new + 1
        assert after[c, t, level, nth] == want
    assert new > 5


def test_thousands_of_quoted_lines(spark):
    """Answers between the lines of a long message, and a long quote of half of it."""
    lines = [f"line number {k} of the long message" for k in range(5000)]
    between = "\n".join(f"> {x}\nanswer {k}" for k, x in enumerate(lines))
    half = "\n".join(f"> {x}" for x in lines[1000:3500]) + "\nthat is it"
    messages = [(1, 0, "u", "\n".join(lines)), (1, 1, "a", between), (1, 2, "u", half), (1, 3, "u", "> same line\n" * 5000)]
    rows = {r["turn"]: r for r in run(spark, messages).collect()}
    assert rows[1]["n_linked"] == 5000 and rows[1]["parent"] == 0
    assert rows[2]["n_linked"] == 1 and rows[2]["parent"] == 0
    assert rows[3]["n_linked"] == 0
