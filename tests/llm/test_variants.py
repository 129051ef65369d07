"""Spelling variants against comparing all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pairloom.llm import variants
from pairloom.llm.queries import op12_variants, table

SF = "/root/testdata/sf0.001"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:]


def plain_groups(counts):
    words, rows = sorted(counts), {}
    for w in words:
        found = [x for x in words if near(w, x)]
        form = min(found, key=lambda x: (-counts[x], x), default=None)
        form = form if form and counts[form] >= 5 * counts[w] else None
        rows[w] = [w, form, w, counts[w], len(found), counts[form] if form else None]
    for w in words:
        while rows[rows[w][2]][1]:
            rows[w][2] = rows[rows[w][2]][1]
    return sorted(map(tuple, rows.values()), key=str)


def plain_counts(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()), key=str)


def vocabulary(n, letters, seed, sizes=(6, 7, 8, 9, 15)):
    draw = random.Random(seed)
    words = {}
    while len(words) < n:
        word = "".join(draw.choice(letters) for _ in range(draw.choice(sizes)))
        for _ in range(4):
            words[word] = draw.choice([5, 5, 6, 24, 25, 26, 125, 700, 4000])
            k = draw.randrange(len(word))
            word = draw.choice([word[:k] + word[k + 1 :], word[:k] + draw.choice(letters) + word[k:], word[:k] + draw.choice(letters) + word[k + 1 :]])
            if len(word) < 6:
                break
    return words


@pytest.mark.parametrize("bucket", [4096, 7])
@pytest.mark.parametrize("letters", ["abc", "abcdefghijklmnopqrstuvwxyzÉéÿ×"])
def test_groups_equal_all_pairs(spark, monkeypatch, letters, bucket):
    monkeypatch.setattr(variants, "BUCKET_WORDS", bucket)
    words = vocabulary(250, letters, len(letters)) | {"x" * 300: 9, "x" * 301: 50, "x" * 299 + "y": 9}
    df = spark.createDataFrame([(w, n, "other") for w, n in words.items()], "word string, n long, key string").repartition(3)
    assert got(variants.group_variants(df)) == plain_groups(words)


def test_a_half_that_all_words_share(spark, monkeypatch):
    monkeypatch.setattr(variants, "BUCKET_WORDS", 50)
    words = {"common" + w: n for w, n in vocabulary(400, "abcd", 5, (3, 5, 6, 7)).items()}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(variants.group_variants(df)) == plain_groups(words)


def test_bits_of_any_number_of_words():
    for n in (1, 63, 64, 65, 200):
        words = sorted(vocabulary(n, "ab", n, (6, 7)))[:n]
        words = np.array([w for w in words if len(w) in (6, 7)], str)
        all_true = np.ones(len(words), bool)
        found = variants.search_bucket(6, False, words, np.arange(len(words)), np.array([w[:3] for w in words], str), all_true, all_true)
        for w, count, *_ in found:
            assert count == sum(near(w, x) and w[:3] == x[:3] and min(len(w), len(x)) == 6 for x in words.tolist())


def test_counts_with_slips_nulls_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(variants, "FLUSH", 50)
    draw = random.Random(2)
    pool = [*vocabulary(60, "abcdeféÉ", 3), "CafÉteria", "short", "xĀyzabcdef", "naiveté"]
    rows = [(draw.choice([None, k, k, k]), " ".join(draw.choice(pool) + draw.choice(["", ",", "-", "1"]) for _ in range(60))) for k in range(100)]
    rows += [(1, None), (2, ""), *rows[:5], (3, "LongText " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counts = variants.count_words(docs, slip_every=199)
    assert {r.word: r.n for r in counts.collect()} == plain_counts(rows)
    assert got(variants.group_variants(counts)) == plain_groups(plain_counts(rows))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, None)], "doc_id long, text string")
    for df in (docs, docs.where("doc_id > 1")):
        assert got(variants.group_variants(variants.count_words(df))) == []


def test_query_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert got(op12_variants(spark, SF)) == plain_groups(plain_counts(rows))
