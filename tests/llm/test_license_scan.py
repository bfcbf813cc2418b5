import random

from lumenfold.llm import license_scan
from tests.llm.conftest import make

MIT, ISC = license_scan.TEMPLATES["mit"], license_scan.TEMPLATES["isc"]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_of_distinct_words_is_the_longest():
    rng = random.Random(6)
    for _ in range(50):
        a, b = rng.sample(range(60), 40), rng.sample(range(60), 40)
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:], strict=False))
        anchored = license_scan.increasing([a.index(w) for w in b if w in a])
        assert len(anchored) == lcs(a, b)


def test_alignment_recurses_into_gaps():
    text = "x the a b the c y the d the".split()
    template = "the a q b the c the d the".split()
    pairs = license_scan.align(text, template)
    assert len(pairs) == lcs(text, template) == 8


def test_finds_edited_notices(spark):
    edited = MIT.replace("person", "human").replace("copyright", "copy right").upper()
    texts = ["before " * 20 + edited + " after", ISC + " " + ISC, "All rights\nreserved. Released under the MIT License", MIT[:250], None, "license " * 50]
    rows = {r["doc_id"]: r for r in license_scan.scan(make(spark, texts)).collect()}
    assert rows[0]["licenses"] == "mit" and 0.9 < rows[0]["coverage"] < 1 and rows[0]["spans"].startswith("mit:20:")
    assert rows[1]["n_notices"] == 2 and rows[1]["licenses"] == "isc" and rows[1]["coverage"] == 1
    assert rows[2]["licenses"] == "all-rights-reserved,mit-notice"
    assert [rows[i]["n_notices"] for i in (3, 4, 5)] == [0, 0, 0] and rows[4]["coverage"] is None


def test_planted_notices_are_all_found(spark):
    rng = random.Random(8)
    names, texts = list(license_scan.TEMPLATES), []
    for i in range(60):
        words = license_scan.TEMPLATES[names[i % len(names)]].split()
        for _ in range(len(words) // 12):
            words[rng.randrange(len(words))] = "edit"
        noise = lambda n: " ".join(rng.choice(["the", "of", "software", "stone", "river", "to"]) for _ in range(n))
        texts.append(noise(rng.randrange(200)) + " " + " ".join(words) + " " + noise(50))
    rows = {r["doc_id"]: r for r in license_scan.scan(make(spark, texts)).collect()}
    assert all(names[i % len(names)] in rows[i]["licenses"].split(",") for i in range(60))


def test_odd_rows(spark, odd, none):
    assert {r["n_notices"] for r in license_scan.scan(odd).collect()} == {0}
    assert license_scan.scan(none).count() == 0


def test_tells_neighbouring_licences_apart():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    names = lambda text: {f[2] for f in scanner.scan(text)}
    gnu = "This work is licensed under the GNU {} License, version {}."
    for text, expected in {
        "Licensed under CC BY-SA 4.0.": {"cc-by-sa-4.0-notice"},
        "Licensed under CC BY 4.0.": {"cc-by-4.0-notice"},
        "Licensed under CC BY-NC 4.0.": {"cc-by-nc-4.0-notice"},
        "Licensed under CC BY-NC-SA 3.0.": {"cc-by-nc-sa-3.0-notice"},
        "Licensed under CC BY-SA 4.0. Licensed under CC BY-NC 4.0.": {"cc-by-sa-4.0-notice", "cc-by-nc-4.0-notice"},
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": {"cc-by-nc-4.0"},
        "Licensed under CC BY 1.0.": set(),
        "Released under the BSD License.": {"bsd-notice"},
        gnu.format("General Public", "2"): {"gpl-2-notice"},
        gnu.format("General Public", "3"): {"gpl-3-notice"},
        gnu.format("Lesser General Public", "3"): {"lgpl-3-notice"},
        gnu.format("Lesser General Public", "2.1"): {"lgpl-2.1-notice"},
        gnu.format("Affero General Public", "3"): {"agpl-3-notice"},
        license_scan.gnu_header("General Public", "2"): {"gpl-2-or-later"},
        license_scan.gnu_header("General Public", "3").replace("program", "library"): {"gpl-3-or-later"},
        **{license_scan.TEMPLATES[n]: {n} for n in ("bsd-2-clause", "bsd-3-clause", "mit", "mit-0", "isc", "0bsd", "mit-opening", "zlib")},
    }.items():
        assert names(text) == expected, text


def test_identifiers_and_short_versions():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    names = lambda text: {f[2] for f in scanner.scan(text)}
    for i in license_scan.SPDX:
        assert names(f"# SPDX-License-Identifier: {i}\nimport os") == {f"spdx-{i.lower()}"}, i
    for text, expected in {
        "GNU General Public License v3.0": "gpl-3-short-notice",
        "the GNU General Public License v2.0 applies": "gpl-2-short-notice",
        "GNU Lesser General Public License v2.1": "lgpl-2.1-short-notice",
        "GNU Affero General Public License v3.0": "agpl-3-short-notice",
        "see the GNU General Public License, version 2": "gpl-2-plain-notice",
        "see the GNU Lesser General Public License, version 3": "lgpl-3-notice",
    }.items():
        assert names(text) == {expected}, (text, names(text))
    assert names("SPDX-License-Identifier: Custom") == set()
