"""License scans by patience alignment.

A template is aligned with a text by the words that occur once in both: of these anchors the longest run
that is increasing in both is taken, and the gaps between anchors are aligned in the same way, where
other words have become unique. Where a gap has no anchor, equal words at its two ends are matched. The
coverage of a template is the share of its words that are matched.

A text is aligned stretch by stretch: every place of a template's rarest words, of which any sufficient
coverage matches one, says where the template would begin. Around each such place the words are aligned, in
the template's own length and in wider ones, so that a notice that stands several times keeps its anchors.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from pairloom.llm.common import fresh, ship

ship(__name__)

LEAST_COVERAGE = 0.8
WORD = re.compile(r"\w+")

SHORT = 8  # wordings of fewer words count only where all their words stand together
WIDER = (0, 4, 1)  # a stretch has a slack of none, a fourth and all of the template's length on both sides
# Words that texts hold without stating a licence; a template is looked for by others first.
COMMON = frozenset("a an and any as by for in is it mit nc no nd of on or sa the this to under version with work you".split())

# --- Fixed values: notices by which texts state their licence -------------------------------------
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
}

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. """ + _WARRANTY
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution."""
_BSD_3 = _BSD_2 + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""


def _named(*names: str) -> list[str]:
    return [f"{start} {name}" for name in names for start in ("Licensed under", "Licensed under the", "Released under", "Released under the", "Distributed under the")]


def _gnu(kind: str, short: str, version: str, dated: str) -> list[str]:
    """Short notices, identifiers, the header of files and the title of the full text."""
    name = f"GNU {kind}General Public License"
    return [
        f"This work is licensed under the {name}, version {version}", f"{name} version {version}", f"{name} v{version}",
        f"{name} {dated}", *_named(f"{short} v{version}", f"{short}v{version}", f"{short} {version}", f"{short}-{version}"),
        f"SPDX-License-Identifier: {short}-{version}", f"SPDX-License-Identifier: {short}-{version}.0",
        f"you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version",
    ]


def _wordings() -> dict[str, list[str]]:
    """All wordings per licence. Long full texts of GNU, Apache and Creative Commons are found by title and header."""
    found = {
        "Apache-2.0": [*_named("Apache 2.0", "Apache-2.0"), "Licensed under the Apache License, Version 2", "Apache License, Version 2.0", "Apache License Version 2.0, January 2004", "Apache License 2.0", "SPDX-License-Identifier: Apache-2.0", _APACHE],
        "BSD-2-Clause": [*_named("BSD 2-Clause License", "BSD-2-Clause"), "BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause", _BSD_2],
        "BSD-3-Clause": [*_named("BSD 3-Clause License", "BSD-3-Clause"), "BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause", _BSD_3],
        "CC0-1.0": [*_named("CC0 1.0", "CC0"), "CC0 1.0 Universal", "SPDX-License-Identifier: CC0-1.0"],
        "GPL-2.0": _gnu("", "GPL", "2", "Version 2, June 1991"),
        "GPL-3.0": _gnu("", "GPL", "3", "Version 3, 29 June 2007"),
        "LGPL-2.1": _gnu("Lesser ", "LGPL", "2.1", "Version 2.1, February 1999"),
        "LGPL-3.0": _gnu("Lesser ", "LGPL", "3", "Version 3, 29 June 2007"),
        "AGPL-3.0": _gnu("Affero ", "AGPL", "3", "Version 3, 19 November 2007"),
        "ISC": [*_named("ISC License"), "The ISC License", "SPDX-License-Identifier: ISC", _ISC],
        "MIT": [*_named("MIT License", "MIT"), "The MIT License", "MIT License", "SPDX-License-Identifier: MIT", _MIT],
        "MPL-2.0": [*_named("MPL 2.0"), "Mozilla Public License Version 2.0", "Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"],
    }
    parts = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            long = "-".join(parts[k] for k in kind.split("-"))
            names = dict.fromkeys([long, long.replace("NonCommercial", "Non-Commercial").replace("NoDerivatives", "NoDerivs")])
            end = {"4.0": " International", "3.0": " Unported"}.get(version, "")
            found[f"CC-{kind}-{version}"] = [
                *[f"This work is licensed under a Creative Commons {n} {version}{end} License" for n in names],
                *[f"Creative Commons {n} {version}{e}{p} License" for n in names for e in {end, ""} for p in ("", " Public")],
                *[f"Creative Commons {n} {version}" for n in names],
                *_named(f"CC {kind} {version}"), f"CC {kind} {version}",
            ]
    for name, notice in TEMPLATES.items():
        found[name] = list(dict.fromkeys([notice, *found[name]]))
    return found


WORDINGS = _wordings()
# --------------------------------------------------------------------------------------------------


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence of different numbers."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, value in enumerate(values):
        k = bisect.bisect_left(tails, value)
        if k == len(tails):
            tails.append(value)
            at.append(i)
        else:
            tails[k], at[k] = value, i
        before[i] = at[k - 1] if k else -1
    found, i = [], at[-1] if at else -1
    while i >= 0:
        found.append(i)
        i = before[i]
    return found[::-1]


def align(template: list[str], text: list[str]) -> list[tuple[int, int]]:
    """Matched places, increasing in both."""
    matched: list[tuple[int, int]] = []
    gaps = [(0, len(template), 0, len(text))]
    while gaps:
        a, b, c, d = gaps.pop()
        if a >= b or c >= d:
            continue
        wanted = Counter(template[a:b])
        place: dict[str, int] = {}
        twice: set[str] = set()
        for k in range(c, d):
            word = text[k]
            if wanted.get(word) == 1:
                (twice.add(word) if word in place else place.setdefault(word, k))
        anchors = [(i, place[template[i]]) for i in range(a, b) if template[i] in place and template[i] not in twice]
        anchors = [anchors[k] for k in longest_increasing([j for _, j in anchors])]
        if anchors:
            matched += anchors
            edges = [(a - 1, c - 1), *anchors, (b, d)]
            gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
            continue
        while a < b and c < d and template[a] == text[c]:
            matched.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            matched.append((b, d))
    return sorted(matched)


def closeness(found: tuple[int, int, int, int]) -> int:
    """Matched words less those that stand between them."""
    return 2 * found[0] - (found[3] - found[2] + 1)


class Template:
    """A wording of a licence, and the words by which it is looked for."""

    def __init__(self, name: str, wording: str, least: float):
        self.name, self.words = name, words_of(wording)
        n = len(self.words)
        self.least = n if n < SHORT else math.ceil(least * n - 1e-9)  # words that must be matched
        self.counts = Counter(self.words)
        # Of so many words any alignment with `least` words matches at least one.
        rare = sorted(range(n), key=lambda k: (self.words[k] in COMMON, self.words[k].isdigit(), -len(self.words[k]), k))
        self.rare = rare[: n - self.least + 1]

    def stretches(self, text: list[str], places: Mapping[str, list[int]]) -> Iterator[tuple[int, int, int, int]]:
        """``matched, words, first, last`` of the best alignment at each place where the template may begin."""
        n = len(self.words)
        for start in sorted({p - k for k in self.rare for p in places.get(self.words[k], ())}):
            if text[max(start, 0) : start + n] == self.words:
                yield n, n, start, start + n - 1
                continue
            if n < SHORT:
                continue
            best = None
            for part in WIDER:
                slack = n // part if part else 0
                low = max(0, start - slack)
                window = text[low : start + n + slack]
                there = Counter(window)
                if sum(min(c, there[w]) for w, c in self.counts.items()) < self.least:
                    continue
                matched = align(self.words, window)
                if len(matched) >= self.least:
                    found = len(matched), n, low + matched[0][1], low + matched[-1][1]
                    best = found if best is None else max(best, found, key=closeness)
            if best:
                yield best


def statements(t: str | None, templates: list[Template], index: Mapping[str, list[int]]) -> list[tuple[str, float, int, int]]:
    """``license, coverage, first_word, last_word`` of every statement of a licence in a text, in order.

    Where alignments overlap, the one counts that matches most words, less those between them: a notice is not
    one of a variant as well. Of equal ones the better covered counts, then the first by name, then by place.
    """
    words = words_of(t)
    counts = Counter(words)
    wanted = sorted({k for w in index.keys() & counts.keys() for k in index[w]})
    # No alignment matches more words than the two have in common.
    wanted = [x for x in map(templates.__getitem__, wanted) if sum(min(n, counts[w]) for w, n in x.counts.items()) >= x.least]
    if not wanted:
        return []
    rare = {x.words[k] for x in wanted for k in x.rare}
    places: dict[str, list[int]] = {}
    for at, word in enumerate(words):
        if word in rare:
            places.setdefault(word, []).append(at)
    found = {(-closeness(f), -f[0] / f[1], x.name, f[2], f[3]) for x in wanted for f in x.stretches(words, places)}
    starts: list[int] = []
    kept: list[tuple[str, float, int, int]] = []
    for _, coverage, name, first, last in sorted(found):
        k = bisect.bisect_left(starts, first)
        if (k and kept[k - 1][3] >= first) or (k < len(kept) and kept[k][2] <= last):
            continue
        starts.insert(k, first)
        kept.insert(k, (name, -coverage, first, last))
    return kept


def scan(docs: DataFrame, templates: Mapping[str, str | list[str]] = WORDINGS, text: str = "text", least: float = LEAST_COVERAGE) -> DataFrame:
    """Adds ``license``, ``coverage``, ``first_word`` and ``last_word`` of the best statement, and ``licenses``.

    ``licenses`` lists all statements of licences that reach ``least``, with the same four values, in order of
    their places; without any it is empty and the others are null. A template has one wording or several;
    those of fewer than ``SHORT`` words must stand in the text whole. The best statement is the one best
    covered, then the longest, then the first by name and place; places count words from 0. Null and empty
    texts have no licence. Rows and columns stay; clashing names get an underscore.
    """
    names = fresh(docs, "license", "coverage", "first_word", "last_word", "licenses")
    kinds = [T.StringType(), T.DoubleType(), T.LongType(), T.LongType()]
    one = T.StructType([T.StructField(n, k) for n, k in zip(("license", "coverage", "first_word", "last_word"), kinds)])
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(names, [*kinds, T.ArrayType(one)])]])
    place = docs.columns.index(text)
    arrow = [pa.string(), pa.float64(), pa.int64(), pa.int64()]
    listed = pa.list_(pa.struct(list(zip(one.names, arrow))))
    prepared = [Template(n, w, least) for n in sorted(templates) for w in ([templates[n]] if isinstance(templates[n], str) else templates[n]) if words_of(w)]
    index: dict[str, list[int]] = {}
    for k, template in enumerate(prepared):
        for word in {template.words[i] for i in template.rare}:
            index.setdefault(word, []).append(k)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                found = [statements(t, prepared, index) for t in batch.column(place).to_pylist()]
                rows = [min(f, key=lambda s: (-s[1], s[2] - s[3], s[0], s[2]), default=(None,) * 4) for f in found]
                added = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(arrow)]
                every = pa.array([[dict(zip(one.names, s)) for s in f] for f in found], listed)
                yield pa.RecordBatch.from_arrays([*batch.columns, *added, every], names=[*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)
