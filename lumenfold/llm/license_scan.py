"""License scan by patience alignment of texts with notice templates.

Words are runs of letters and digits in lower case. For each template, a stretch of text of
``STRETCH`` times its length is a candidate if it holds enough words of the template for the least
coverage. A candidate is aligned: equal ends are matched; words that stand once in both
are anchors, of which the longest increasing subsequence is kept; the gaps between kept
anchors are aligned in the same way. The coverage is the share of the template's words
that are matched. The words that tell licences apart (numbers, ``TELLING``, in short notices ``NAMES``)
must be matched, and no word of ``TELLING`` may be put between neighbouring words of the template.
Of overlapping candidates the best one counts, the earlier of equals; a
template can be found many times in a text. A notice of which most lies in the span of
another one, of which more words are matched, is a part of that one and not told.

Whole texts are scanned, inside their row, without a shuffle. A null or empty text has no license.
Equal ids and repeated rows are scanned one by one; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 0.8
STRETCH = 1.5
WORDS = re.compile(r"[^\W_]+")

# Words that tell licences apart: a template's own must be matched, and none may be put between its matched words.
TELLING = frozenset(
    "sa nc nd sharealike noncommercial noderivatives noderivs lesser affero library zero cc0 endorse unlicense".split()
)
# In notices of less than NAMED words the name of the licence must be matched as well.
NAMES = frozenset("mit apache bsd isc zlib gpl lgpl agpl mpl epl bsl mozilla eclipse boost cc creative".split())
NAMED = 12

AS_IS = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so"
)
MIT_TERMS = (
    ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the Software."
)
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_TERMS = ", provided that the above copyright notice and this permission notice appear in all copies."
ISC_AS_IS = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer."
)
BSD_BINARY = (
    " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
BSD_NAMES = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
BSD_AS_IS = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def gnu_header(name: str, version: str) -> str:
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
        f"License as published by the Free Software Foundation, either version {version} of the License, or (at your option) "
        "any later version."
    )


GNU = {
    "gpl-3": ("General Public", "3"),
    "gpl-2": ("General Public", "2"),
    "lgpl-3": ("Lesser General Public", "3"),
    "lgpl-2.1": ("Lesser General Public", "2.1"),
    "lgpl-2": ("Library General Public", "2"),
    "agpl-3": ("Affero General Public", "3"),
}
CC = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nc": "Attribution-NonCommercial",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}

# Identifiers of licences in source files.
SPDX = (
    "MIT MIT-0 ISC 0BSD BSD-2-Clause BSD-3-Clause Zlib Unlicense Apache-2.0 MPL-2.0 EPL-2.0 BSL-1.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 "
    "GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later "
    "AGPL-3.0-only AGPL-3.0-or-later"
).split()

# Common notices in a short wording, the headers that licences ask for, and whole texts of the
# short licences. The openings find texts that break off.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "all-rights-reserved": "All rights reserved.",
    "bsd-notice": "Released under the BSD License.",
    "isc-notice": "Released under the ISC License.",
    "mpl-2.0-notice": "Licensed under the Mozilla Public License, version 2.0.",
    "epl-2.0-notice": "Licensed under the Eclipse Public License, version 2.0.",
    "bsl-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "cc0-1.0-notice": "Licensed under CC0 1.0.",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    **{f"{k}-notice": f"Licensed under the GNU {name} License, version {v}." for k, (name, v) in GNU.items() if k != "gpl-3"},
    **{f"cc-{k}-{v}-notice": f"Licensed under CC {k} {v}." for k in CC for v in ("4.0", "3.0", "2.5", "2.0")},
    **{f"cc-{k}-{v}": f"Licensed under a Creative Commons {name} {v} License." for k, name in CC.items() for v in ("4.0", "3.0", "2.5", "2.0")},
    "mit": MIT_GRANT + MIT_TERMS + AS_IS,
    "mit-opening": MIT_GRANT + MIT_TERMS,
    "mit-0": MIT_GRANT + "." + AS_IS,
    "isc": ISC_GRANT + ISC_TERMS + ISC_AS_IS,
    "isc-opening": ISC_GRANT + ISC_TERMS,
    "0bsd": ISC_GRANT + "." + ISC_AS_IS,
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "bsd": BSD_OPENING,
    "bsd-2-clause": BSD_OPENING + BSD_BINARY + BSD_AS_IS,
    "bsd-3-clause": BSD_OPENING + BSD_BINARY + BSD_NAMES + BSD_AS_IS,
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the "
        "original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. This notice may not be removed or altered from any source distribution."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ),
    **{f"{k}-or-later": gnu_header(*v) for k, v in GNU.items()},
    **{f"{k}-short-notice": f"GNU {name} License v{v if '.' in v else v + '.0'}" for k, (name, v) in GNU.items()},
    **{f"gpl-{v}-plain-notice": f"GNU General Public License, version {v}." for v in ("2", "3")},
    **{f"spdx-{i.lower()}": f"SPDX-License-Identifier: {i}" for i in SPDX},
}


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def telling(word: str) -> bool:
    return word in TELLING or word.removeprefix("v").isdecimal()


def increasing(values: Sequence[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        p = bisect_left(tops, v)
        before.append(piles[p - 1] if p else -1)
        if p == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[p], piles[p] = v, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(text: Sequence, template: Sequence) -> list[tuple[int, int]]:
    """Matched (text place, template place) pairs, increasing in both."""
    found: list[tuple[int, int]] = []
    work = [(0, len(text), 0, len(template))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and text[a] == template[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(text[a:b], a) if in_text[w] == 1 and in_template[w] == 1}
        pairs = [(place[w], j) for j, w in enumerate(template[c:d], c) if w in place]
        kept = [pairs[i] for i in increasing([p for p, _ in pairs])]
        found.extend(kept)
        if kept:
            edges = [(a - 1, c - 1), *kept, (b, d)]
            work.extend((p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:], strict=False))
    return sorted(found)


class Scanner:
    """Templates with one numbering of their words."""

    def __init__(self, templates: dict[str, str], least: float = LEAST, stretch: float = STRETCH):
        self.number: dict[str, int] = {}
        self.least, self.templates = least, []
        listed = {name: [self.number.setdefault(w, len(self.number)) for w in words_of(t)] for name, t in templates.items()}
        self.lengths = {name: len(ids) for name, ids in listed.items()}
        for name, ids in listed.items():
            if ids:
                member = np.zeros(len(self.number), bool)
                member[ids] = True
                listed_words = words_of(templates[name])
                must = {i for w, i in zip(listed_words, ids, strict=True) if telling(w) or len(ids) < NAMED and w in NAMES}
                needed = math.ceil(least * len(ids) - 1e-9)
                self.templates.append((name, ids, member, needed, math.ceil(stretch * len(ids)) + 1, must))
        self.words = len(self.number)
        self.rivals = {self.number.setdefault(w, len(self.number)) for w in sorted(TELLING)}

    def scan(self, text: str | None) -> list[tuple[int, int, str, float]]:
        """(first word, past last word, template, coverage) of every notice found."""
        ids = np.array([self.number.get(w, -1) for w in words_of(text)], np.int64)
        known = np.flatnonzero((ids >= 0) & (ids < self.words))
        there = set(ids[known].tolist())
        found = []
        for name, template, member, needed, width, must in self.templates:
            if not must <= there:
                continue
            at = known[member[ids[known]]]
            if len(at) < needed:
                continue
            near = np.flatnonzero(at[needed - 1 :] - at[: len(at) - needed + 1] < width)
            best: tuple[int, int, str, float] | None = None
            for start in at[near].tolist():
                if best and start >= best[1]:
                    found.append(best)
                    best = None
                stretch = ids[start : start + width].tolist()
                if best and best[3] == 1 or sum((Counter(stretch) & Counter(template)).values()) < needed:
                    continue
                pairs = align(stretch, template)
                if not self.tells(stretch, template, pairs, must):
                    continue
                if len(pairs) >= needed and (best is None or len(pairs) / len(template) > best[3]):
                    best = (start + pairs[0][0], start + pairs[-1][0] + 1, name, len(pairs) / len(template))
            if best:
                found.append(best)
        found.sort()
        starts, widest = [f[0] for f in found], max((t[4] for t in self.templates), default=0)
        near = lambda f: found[bisect_left(starts, f[0] - widest) : bisect_left(starts, f[1])]
        return [f for f in found if not any(self.within(f, g) for g in near(f))]

    def tells(self, stretch: list[int], template: list[int], pairs: list[tuple[int, int]], must: set[int]) -> bool:
        """Whether the telling words of the template are matched, with no other put between two of its neighbouring words."""
        if not must <= {template[q] for _, q in pairs}:
            return False
        neighbours = zip(pairs, pairs[1:], strict=False)
        return not any(s == q + 1 and not self.rivals.isdisjoint(stretch[p + 1 : r]) for (p, q), (r, s) in neighbours)

    def within(self, one: tuple[int, int, str, float], other: tuple[int, int, str, float]) -> bool:
        """Whether most of ``one`` lies in ``other``, a template of which more words are matched, or an equal number of a shorter one."""
        matched = [(round(f[3] * self.lengths[f[2]]), f[3]) for f in (one, other)]
        shared = min(one[1], other[1]) - max(one[0], other[0])
        return 2 * shared > one[1] - one[0] and matched[0] < matched[1]


RESULT = "array<struct<start:long,end:long,license:string,coverage:double>>"


def with_licenses(docs: DataFrame, into: str, templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """``docs`` with the notices of every text as column ``into``: word span, template and coverage."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("coverage", pa.float64())]))

    @F.arrow_udf(RESULT)
    def notices(texts: pa.Array) -> pa.Array:
        scanner = Scanner(templates, least)
        names = ("start", "end", "license", "coverage")
        return pa.array([[dict(zip(names, f, strict=True)) for f in scanner.scan(t.as_py())] for t in texts], kind)

    return docs.withColumn(into, notices(F.col("text").cast("string")))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """Per document row: doc_id, n_notices, licenses (distinct, sorted), coverage (the best, null if none), spans."""
    found = with_licenses(docs.select("doc_id", "text"), "_found", templates, least)
    part = lambda f: F.concat_ws(":", f["license"], f["start"], f["end"], F.format_number(f["coverage"], 4))
    return found.select(
        "doc_id",
        F.size("_found").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct("_found.license")), ",").alias("licenses"),
        F.round(F.array_max("_found.coverage"), 6).alias("coverage"),
        F.array_join(F.transform("_found", part), ",").alias("spans"),
    )
