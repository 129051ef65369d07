"""Patience alignment against planted notices and plain definitions."""

from __future__ import annotations

import itertools
import random

from pairloom.llm import licenses
from pairloom.llm.queries import QUERIES, table


def test_longest_increasing():
    draw = random.Random(1)
    for _ in range(200):
        values = draw.sample(range(9), draw.randint(0, 8))
        found = [values[k] for k in licenses.longest_increasing(values)]
        best = max(n for n in range(len(values) + 1) for c in itertools.combinations(values, n) if list(c) == sorted(c))
        assert found == sorted(found) and len(found) == best


def test_alignment_is_increasing_and_equal():
    draw = random.Random(2)
    for _ in range(300):
        a, b = ([draw.choice("abcdefg") for _ in range(draw.randint(0, 12))] for _ in range(2))
        matched = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in matched)
        assert all(i < k and j < m for (i, j), (k, m) in zip(matched, matched[1:]))
        assert licenses.align(a, a) == [(i, i) for i in range(len(a))]


def test_awkward_rows(spark):
    gpl = licenses.TEMPLATES["GPL-3.0"]
    rows = [(1, None, "x"), (2, "", "x"), (3, "w " * 30000 + gpl.upper() + " the work", "x"), (4, gpl, None), (4, gpl, None), (5, "This work is", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    out = licenses.scan(docs)
    assert sorted((r.doc_id, r.license_ or "", r.first_word) for r in out.collect() if r.license_) == [(3, "GPL-3.0", 30000), (4, "GPL-3.0", 0), (4, "GPL-3.0", 0)]
    assert out.count() == 6 and licenses.scan(docs.limit(0)).count() == 0


def test_query_finds_stated_notices(spark):
    sf = "/root/testdata/sf0.01"
    stated = {r.doc_id for r in table(spark, sf, "documents").where("text LIKE '%under the GNU General Public License, version 3%'").collect()}
    found = {r.doc_id for r in QUERIES["op4_licenses"](spark, sf).where("license = 'GPL-3.0'").collect()}
    assert stated and stated <= found


def stated(text, templates=licenses.WORDINGS):
    docs = [licenses.Template(n, w, licenses.LEAST_COVERAGE) for n in sorted(templates) for w in templates[n]]
    index = {}
    for k, t in enumerate(docs):
        for i in t.rare:
            index.setdefault(t.words[i], []).append(k)
    return licenses.statements(text, docs, index)


def test_every_wording_is_found_as_its_licence():
    for name, wordings in licenses.WORDINGS.items():
        for wording in wordings:
            found = stated(f"some words before. {wording}; and others after it")
            assert [s[0] for s in found] == [name] and found[0][1] == 1.0, (name, wording, found)


def test_notices_that_are_repeated():
    filler = " ".join(f"f{k}" for k in range(200))
    for name, notice in licenses.TEMPLATES.items():
        changed = notice.replace("licensed", "lent").replace("hereby", "thereby").replace("Version", "Edition")
        bodies = [(2, f"{notice} {filler} {notice}"), (2, f"{notice} {notice}"), (300, " ".join([notice] * 300)), (2, f"{changed} {filler} {changed}")]
        for times, body in bodies:
            found = stated(body)
            assert {s[0] for s in found} == {name} and len(found) == times, (name, body[:200])
    words = filler + " " + licenses.TEMPLATES["GPL-3.0"] + " " + "the license is a work of the public version 3 " * 50
    assert [s[0] for s in stated(words)] == ["GPL-3.0"]


def test_several_licences_of_one_text():
    found = stated("Released under the MIT License. Docs: licensed under CC BY-NC 4.0. Released under the Other License")
    assert [s[0] for s in found] == ["MIT", "CC-BY-NC-4.0"]


def test_query_agrees_with_plain_search(spark):
    sf = "/root/testdata/sf0.1"
    plain = {"GPL-3.0": "under the GNU General Public License, version 3", "MIT": "Released under the MIT License", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0", "Apache-2.0": "Licensed under the Apache License, Version 2.0"}
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    found = {(r.doc_id, s.license) for r in QUERIES["op4_licenses"](spark, sf).collect() for s in r.licenses}
    assert found == {(d, n) for d, t in texts.items() for n, p in plain.items() if p in (t or "")}
