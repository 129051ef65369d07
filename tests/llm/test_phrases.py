"""Phrase collocations against counting all phrases one by one."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pairloom.llm import phrases

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def lowered(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain(rows, least, longest=5, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text or "")):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: c for p, c in counts.items() if len(p) >= 2 and c >= least}
        found = []
        for p, a in candidates.items():
            around = [c for q, c in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * c >= 100 * a for c in around):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), p, counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, _, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, " ".join(p), -a, left, right, n[lang], -score))
    return sorted(out)


def got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def texts(n, seed=1):
    draw = random.Random(seed)
    pools = {lang: [draw.choice("abcdeéß#'") * draw.randrange(1, 4) + str(k) for k in range(12)] for lang in ("en", "de", None)}
    fixed = [" ".join(draw.choice(pools["en"]) for _ in range(k)) for k in (2, 3, 4, 5, 7)]
    rows = []
    for _ in range(n):
        lang = draw.choice(["en", "en", "en", "de", None, "und"])
        words = []
        for _ in range(draw.randrange(40)):
            words.append(draw.choice(fixed) if draw.random() < 0.2 else min(draw.choices(pools[lang if lang != "und" else None], k=2)))
            words.append(draw.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", " ! ", "\r\n"]))
        rows.append((lang, "".join(w.upper() if draw.random() < 0.1 else w for w in words)))
    return [*rows, *rows[:10], ("en", None), ("fr", ""), ("fr", " .,; "), ("es", "one"), ("en", "a a a a a a a a. " * 30)]


@pytest.mark.parametrize("least,top", [(3, 2000), (8, 25), (40, None)])
def test_equals_counting_phrases(spark, monkeypatch, least, top):
    monkeypatch.setattr(phrases, "UNIT_BYTES", 3000)
    monkeypatch.setattr(phrases, "GROUP_WORDS", 900)
    rows = texts(250)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert got(phrases.mine(docs, least=least, top=top)) == plain(rows, least, top=top)


@pytest.mark.parametrize("tile,dense,of_tiles", [(2, 16, 256), (4, 4, 3), (1024, 1 << 19, 1)])
def test_any_tiling_gives_the_same(spark, monkeypatch, tile, dense, of_tiles):
    monkeypatch.setattr(phrases, "TILE", tile)
    monkeypatch.setattr(phrases, "DENSE", dense)
    monkeypatch.setattr(phrases, "GROUPS_OF_TILES", of_tiles)
    monkeypatch.setattr(phrases, "GROUP_WORDS", 300)
    rows = texts(80, seed=9)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert got(phrases.mine(docs, least=4)) == plain(rows, 4)


@pytest.mark.parametrize("tile", [2, 64, 1024])
def test_pairs_in_dense_and_sparse_tiles(monkeypatch, tile):
    monkeypatch.setattr(phrases, "TILE", tile)
    draw = np.random.default_rng(tile)
    for n, ids in ((0, 5), (1, 5), (5000, 9), (20_000, 3000)):
        i, j = (np.minimum(draw.geometric(0.02, n) * draw.integers(1, 4, n), ids) * 7 for _ in range(2))
        a, b, c = phrases.count_pairs(i, j)
        assert Counter(dict(zip(zip(a.tolist(), b.tolist()), c.tolist()))) == Counter(zip(i.tolist(), j.tolist()))
        assert len(a) == len(set(zip(a.tolist(), b.tolist())))


def test_packing():
    for numbers in ([], [0], [-1, 5, 2**40, -(2**62)], list(range(1000))):
        assert phrases.unpack(phrases.pack(np.array(numbers, np.int64))).tolist() == numbers


def test_scores_beyond_64_bits(spark):
    f = 10**13
    df = spark.createDataFrame([(f, 9 * 10**14, [f + 7, f], [f + 9, f])], "f long, n long, heads array<long>, tails array<long>")
    best = df.select(phrases._scores(2).alias("s")).head().s
    assert (best.score, best.k, best.l, best.r) == (1000 * f * 9 * 10**14 // ((f + 7) * (f + 9)), 1, f + 7, f + 9)


def test_clashing_names_long_texts_and_empty_tables(spark):
    rows = [("en", "new york city " * 20_000, 1), ("en", "new york", 2)]
    docs = spark.createDataFrame(rows, "lang string, text string, unit int")
    assert got(phrases.mine(docs)) == plain([r[:2] for r in rows], 100)
    assert got(phrases.mine(docs.where("unit > 5"))) == []
    assert got(phrases.mine(docs.select(docs.lang, docs.text.substr(1, 3).alias("text")))) == []
