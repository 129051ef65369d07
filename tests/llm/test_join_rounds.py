"""Families of near copies that no single centre links: the later rounds of the n-gram join."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from pairloom.llm import jaccard
from tests.llm.test_search_and_join import expected, found


def grid(side, length=24):
    """The same middle; the first and the last word vary, so only texts that share one of them link."""
    middle = " ".join(f"m{k}" for k in range(length))
    return [(side * i + j, f"first{i} {middle} last{j}") for i in range(side) for j in range(side)]


def family(n, length, changes, seed):
    """Copies of a text that is not there itself, each with some words replaced."""
    draw = random.Random(seed)
    base = [f"w{k}" for k in range(length)]
    out = []
    for k in range(n):
        words = list(base)
        for at in draw.sample(range(length), changes):
            words[at] = f"x{draw.randrange(10**9)}"
        out.append((k + 1000 * seed, " ".join(words)))
    return out


@pytest.mark.parametrize("centres", [500, 3])
def test_a_grid_of_copies(spark, monkeypatch, centres):
    monkeypatch.setattr(jaccard, "CENTRES", centres)
    docs = grid(7)
    assert found(spark, docs) == expected(docs)


@pytest.mark.parametrize("worthwhile,block", [(16, 2048), (0, 2048), (16, 6)])
def test_families_around_the_limit(spark, monkeypatch, worthwhile, block):
    """With 0 merging stops after two rounds, and the rest is left to completing."""
    monkeypatch.setattr(jaccard, "WORTHWHILE", worthwhile)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    docs = family(25, 120, 1, 1) + family(25, 120, 2, 2) + family(20, 60, 1, 3) + [(9000 + k, f"alone {k} " * 9) for k in range(5)]
    docs += [(None, docs[3][1]), (7, docs[30][1])]
    assert found(spark, docs) == expected(docs)


def test_pairs_grow_in_proportion(spark, monkeypatch):
    """Four times the texts of a family may not have much more than four times the compared pairs."""
    counts = []
    for side in (8, 16):
        seen = []
        real = jaccard.links_among
        monkeypatch.setattr(jaccard, "links_among", lambda pairs, *rest: seen.append(pairs.count()) or real(pairs, *rest))
        rows = found(spark, grid(side))
        assert len({r[2] for r in rows}) == 1
        monkeypatch.setattr(jaccard, "links_among", real)
        counts.append(sum(seen))
    assert counts[1] <= 6 * counts[0], counts


def test_long_sketches_never_differ_in_more_than_the_sets():
    draw = np.random.default_rng(3)
    for n in (801, 1000, 1023, 1024, 1025, 3000):
        for share in (0.0, 0.05, 0.3, 1.0):
            base = draw.integers(0, 2**64, n, np.uint64)
            gone = int(n * share)
            other = np.concatenate([base[gone:], draw.integers(0, 2**64, draw.integers(0, gone + 1), np.uint64)])
            if len(other) <= jaccard.LONG_SET:
                continue
            x, y = (np.frombuffer(jaccard.long_sketch(v), np.uint8) for v in (base, other))
            apart = jaccard.sketches_apart(x, y)
            assert apart <= len(np.setxor1d(base, other))
            assert share < 1 or apart * 185 > (n + len(other)) * 15  # unrelated sets are told
    assert jaccard.long_sketch(base[:800]) == b""


def test_long_texts_around_the_limit(spark):
    docs = family(6, 1500, 15, 4) + family(6, 2200, 45, 5) + [(9, "w1 w2 " * 2000), (None, " ".join(f"w{k}" for k in range(1500)))]
    assert found(spark, docs) == expected(docs)


def test_python_gets_small_batches(spark, monkeypatch):
    """Texts and sets go to Python in lots of bounded bytes, however many rows there are; the setting comes back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    monkeypatch.setattr(jaccard, "ARROW_BYTES", 1 << 15)
    docs = family(60, 400, 4, 6)
    seen, real = [], jaccard.sets_of

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    def noted(table, *rest):
        seen.extend(r.n for r in table.select("text").coalesce(1).mapInArrow(sizes, "n long").collect())
        return real(table, *rest)

    monkeypatch.setattr(jaccard, "sets_of", noted)
    assert found(spark, docs) == expected(docs)
    assert sum(seen) > 3 * (1 << 15) and max(seen) < 2 * (1 << 15)
    assert spark.conf.get(name) == before


def sharing(n, seed):
    """Texts of their own words but for a passage that all of them hold, and a copy of every tenth with one word changed."""
    draw = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(40))
    docs = []
    for k in range(n):
        own = [f"w{k}x{i}" for i in range(160)]
        at = draw.randrange(160)
        docs.append((2 * k, " ".join([*own[:at], passage, *own[at:]])))
        if k % 10 == 0:
            docs.append((2 * k + 1, " ".join([*own[:at], passage, *own[at:], "changed"])))
    return docs


def test_a_passage_in_many_texts_makes_no_pairs_of_them(spark, monkeypatch):
    """Texts that have only a passage in common are not compared with each other, so that pairs grow with the texts."""
    counts = []
    real = jaccard._possible
    for n in (100, 400):
        seen, open_rows = [], []
        still = jaccard._still_open
        monkeypatch.setattr(jaccard, "_possible", lambda pairs, *rest: seen.append(pairs.count()) or real(pairs, *rest))
        monkeypatch.setattr(jaccard, "_still_open", lambda *given: (out := still(*given), open_rows.append(jaccard._cross_pairs(out[0])))[0])
        docs = sharing(n, n)
        rows = found(spark, docs)
        monkeypatch.undo()
        of = {r[0]: r[2] for r in rows}
        assert all(of[str(key)] == str(key - key % 2) for key, _ in docs)
        counts.append((sum(seen), sum(open_rows)))
    assert counts[1][0] <= 6 * max(counts[0][0], 10) and counts[1][1] <= 6 * max(counts[0][1], 100), counts


def test_sets_that_link_share_a_rare_shingle():
    draw = np.random.default_rng(8)
    for percent in (80, 85):
        for n in (*range(1, 30), 100, 333):
            base = np.unique(draw.integers(0, 2**64, n, np.uint64))
            known = np.unique(np.concatenate([base[draw.random(len(base)) < 0.8], draw.integers(0, 2**64, 50, np.uint64)]))
            counts = draw.integers(2, 9, len(known))
            for gone in range(0, len(base) // 4 + 1):
                other = np.union1d(np.delete(base, draw.choice(len(base), gone, replace=False)), draw.integers(0, 2**64, draw.integers(0, gone + 1), np.uint64))
                same = len(np.intersect1d(base, other))
                if 100 * same < percent * (len(base) + len(other) - same):
                    continue
                for of in (known, counts), (known[:0], counts[:0]):
                    assert len(np.intersect1d(jaccard.rare_shingles(base, percent, *of), jaccard.rare_shingles(other, percent, *of)))


@pytest.mark.parametrize("wide,few_cross", [(1, 32), (2, 0), (10**6, 0)])
def test_narrowed_entries_lose_no_link(spark, monkeypatch, wide, few_cross):
    monkeypatch.setattr(jaccard, "WIDE", wide)
    monkeypatch.setattr(jaccard, "FEW_CROSS", few_cross)
    docs = family(25, 120, 1, 1) + family(25, 120, 2, 2) + family(20, 60, 1, 3) + sharing(30, 4)
    docs = [(key + 10_000 * k, text) for k, (key, text) in enumerate(docs)] + [(None, docs[3][1]), (7, docs[30][1])]
    assert found(spark, docs) == expected(docs)
