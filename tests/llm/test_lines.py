"""Line dedup against a plain recount."""

from __future__ import annotations

import random

import numpy as np
import pytest

from pairloom.llm import lines

SPACES = " \t\n\x0b\x0c\r"


def lowered(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain(rows, least=10):
    """doc_id, text -> n_lines, n_dropped, kept, with null as the largest id."""
    own, place = {}, lambda i: float("inf") if i is None else i
    for i, text in rows:
        for line in (text or "").split("\n"):
            own.setdefault(lowered(line.strip(SPACES)), []).append(place(i))
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        keys = [lowered(line.strip(SPACES)) for line in all_lines]
        kept = [x for x, k in zip(all_lines, keys) if len(k) < least or min(own[k]) == place(i)]
        out.append((i, text, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return out


def order(rows):
    return sorted(rows, key=str)


def texts(n, seed=3):
    draw = random.Random(seed)
    pool = [f"Line of the pool {k} é" for k in range(40)] + ["", "short", "ääääääääää", "äääää", " ten chars  "]
    out = [(None, None), (5, ""), (6, "\n"), (7, "same line twice\nsame line twice"), (7, "same line twice\nother line here")]
    for k in range(n):
        own = [draw.choice(pool) if draw.random() < 0.6 else f"line {k} {draw.random()}" for _ in range(draw.randrange(9))]
        own = [draw.choice(["", " ", "\t\x0b", "\r"]) + (x.upper() if draw.random() < 0.2 else x) + draw.choice(["", " ", "\r"]) for x in own]
        out.append((draw.choice([None, k, k, k, k // 2]), "\n".join(own)))
    return [*out, *out[-20:], (10**6, "\n".join(["the long text's common line"] * 30_000 + ["its own last line"]))]


@pytest.mark.parametrize("hot_floor", [1024, 3])
def test_equals_a_plain_recount(spark, monkeypatch, hot_floor):
    monkeypatch.setattr(lines, "HOT_FLOOR", hot_floor)
    monkeypatch.setattr(lines, "SHARD_BYTES", 100_000)
    rows = texts(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    index = lines.index_lines(docs)
    assert index.n_shards > 5 and (len(index.hot["counts"]) > 0) == (hot_floor == 3)
    got = lines.drop_repeated(docs, index)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped", "kept_text"]
    assert order(map(tuple, got.collect())) == order(plain(rows))


def test_many_small_sendings(spark, monkeypatch):
    monkeypatch.setattr(lines, "FLUSH", 7)
    rows = texts(80, seed=4)[:-1]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert order(map(tuple, lines.drop_repeated(docs, lines.index_lines(docs)).collect())) == order(plain(rows))


def test_a_line_that_a_third_of_rows_share(spark):
    rows = [(k, f"a line that many share\nrow {k} has its own") if k % 3 == 0 else (k, f"row {k} alone here") for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    index = lines.index_lines(docs)
    assert index.hot["counts"].tolist() == [2000]
    assert sum(r.n_dropped for r in lines.drop_repeated(docs, index).collect()) == 1999


def test_clashing_names_and_empty_tables(spark):
    schema = "kept_text int, doc_id long, n_lines string, text string, _k1 double, shard long"
    docs = spark.createDataFrame([(1, 1, "x", "a line of text\nb", 0.5, 3), (2, 2, "y", "A line of text ", 0.5, 3)], schema)
    got = lines.drop_repeated(docs, lines.index_lines(docs))
    assert got.columns == [*docs.columns, "n_lines_", "n_dropped", "kept_text_"]
    assert order((r.kept_text, r.n_lines, r.n_lines_, r.n_dropped, r.kept_text_, r.shard) for r in got.collect()) == [
        (1, "x", 2, 0, "a line of text\nb", 3), (2, "y", 1, 1, "", 3),
    ]
    empty = docs.where("doc_id > 5")
    assert lines.drop_repeated(empty, lines.index_lines(empty)).collect() == []


def test_more_documents_than_two(spark):
    rows = [(k, f"line in three texts\nline in {'two' if k < 2 else 'no other'} texts {k // 2}") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.drop_repeated(docs, lines.index_lines(docs), least_documents=3)
    assert sorted((r.doc_id, r.n_dropped) for r in got.collect()) == [(0, 0), (1, 1), (2, 1)]


@pytest.mark.parametrize("n", [0, 1, 2, 17, 5000])
def test_numbers_are_a_bijection_and_strangers_are_told(n):
    draw = np.random.default_rng(n)
    hashes = draw.integers(0, 2**64, (2 * n, 2), np.uint64)
    counts, owners = draw.integers(1, 4, n), draw.integers(0, 10**9, n)
    shard = lines.build_shard(hashes[:n], counts, owners)
    assert sorted(lines._number(shard, hashes[:n])) == list(range(n))
    found, own = lines.probe_shard(shard, hashes)
    assert found.tolist() == [*counts, *[0] * n]
    assert own[:n].tolist() == np.where(counts >= 2, owners, -1).tolist()
