"""Nearest neighbours, the similarity join, components and the pipeline, against brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairloom.llm import jaccard, neighbours
from pairloom.llm.components import components
from pairloom.llm.queries import QUERIES, table
from pairloom.session import new_folder

SF = "/root/testdata/sf0.01"


class Forest:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def expected(docs):
    """``(n_shingles, component)`` per row, rows being told apart by place."""
    sets = [shingles(t) for _, t in docs]
    forest = Forest(range(len(docs)))
    for a, b in itertools.combinations(range(len(docs)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            forest.join(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            root = forest.find(i)
            least[root] = min(least.get(root, doc_id), doc_id)
    return sorted((str(d), len(sets[i]), str(least.get(forest.find(i)))) for i, (d, _) in enumerate(docs))


def found(spark, docs):
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, node string")
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.near_copies(frame).collect())


def test_join_of_random_groups(spark):
    """Chains of near copies around the limit, of all sizes, with hot lines shared by many."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdé") for _ in range(3))
    hot = [word() for _ in range(40)]
    docs = []
    for group in range(40):
        base = [word() for _ in range(draw.choice([1, 3, 5, 9, 12, 20, 60, 150, 400]))]
        if draw.random() < 0.5:
            base = hot + base
        for _ in range(draw.choice([1, 2, 3, 8])):
            docs.append((len(docs), " ".join(base)))
            for _ in range(max(1, len(base) // draw.choice([30, 60, 100]))):
                base[draw.randrange(len(base))] = word()
    docs += [(None, docs[5][1]), (None, "alone here now then"), (7, docs[3][1]), (7, docs[3][1]), (900, None), (901, " \n"), (902, "A b"), (903, "a B")]
    assert found(spark, docs) == expected(docs)


def test_join_past_the_first_centres(spark, monkeypatch):
    """Unrelated documents under one index entry are compared with each other, block by block."""
    monkeypatch.setattr(jaccard, "CENTRES", 2)
    draw = random.Random(9)
    passage = [str(k) for k in range(60)]
    docs = []
    for _ in range(30):
        tail = [f"x{draw.randrange(10**6)}" for _ in range(8)]
        docs += [(len(docs) + k, " ".join(passage + tail[: 8 - k])) for k in range(2)]
    assert found(spark, docs) == expected(docs)


def test_index_never_loses_a_link():
    """Sets at the limit share an entry, whatever is frequent and therefore skipped."""
    bands, draw = jaccard.Bands.of(85), np.random.default_rng(6)
    for size in (6, 7, 13, 20, 47, 100, 301, 1000):
        for _ in range(60):
            union = np.unique(draw.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
            differ = len(union) * 15 // 100
            gone = draw.permutation(len(union))[:differ]
            cut = draw.integers(0, differ + 1)
            a, b = np.delete(union, gone[:cut]), np.delete(union, gone[cut:])
            frequent = np.sort(draw.permutation(union)[: draw.integers(0, len(union) + 1)])
            shared = np.intersect1d(jaccard.index_entries(a, bands, frequent), jaccard.index_entries(b, bands, frequent))
            assert len(shared) or np.array_equal(a, b)


def test_join_of_nothing(spark):
    assert found(spark, []) == [] and found(spark, [(1, None)]) == [("1", 0, "1")]


def test_components_of_long_chains_and_stars(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1400)] + [(2000, 2000), (None, 3)]
    draw.shuffle(edges)
    forest = Forest(range(2001))
    for a, b in edges:
        if a is not None:
            forest.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: forest.find(n) for e in edges for n in e if None not in e and e[0] != e[1]}


def brute(rows, k=20):
    best = {}
    for q, v in rows:
        if q % 20 == 0:
            scored = sorted({(-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v)})
            best[q] = scored[:k]
    return best


def test_nearest_of_awkward_vectors(spark):
    draw = np.random.default_rng(4)
    vectors = [(int(i), [float(x) for x in draw.integers(-3, 4, 6)]) for i in range(80)]
    vectors += [(100 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(60)]  # more copies than are asked for
    vectors += [(200, [5.0, 1.0]), (220, [1.0, 1.0])]
    bad = [(300, None), (320, []), (340, [0.0] * 6), (360, [float("nan")] + [1.0] * 5), (380, [float("inf")] + [1.0] * 5), (400, [None] + [1.0] * 5), (None, [1.0] * 6)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in [*vectors, vectors[3], *bad]], "vec_id long, embedding array<double>, rank string")
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    used = [(i, v) for i, v in vectors if any(v)]
    wanted = brute(used)
    assert set(got) == {q for q in wanted if wanted[q]}
    for q, rows in got.items():
        assert [(n, i) for n, i, _ in sorted(rows)] == [(n + 1, i) for n, (_, i) in enumerate(wanted[q])]
        assert all(s == pytest.approx(-w) for (_, _, s), (w, _) in zip(sorted(rows), wanted[q]))
    assert neighbours.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    rows = [(r.vec_id, np.array(r.embedding)) for r in table(spark, f"/root/testdata/{sf}", "embeddings").collect()]
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    got = {}
    for r in QUERIES["op2_nearest"](spark, f"/root/testdata/{sf}").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        hits, total = hits + len(got[ids[q]] & set(best.tolist())), total + len(best)
    assert hits / total >= 0.9


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, SF, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        folder = new_folder(spark, "stage-test")
        stage(spark, docs, SF).write.parquet(folder)
        docs = spark.read.parquet(folder)
        sizes.append(docs.count())
        if number < 4:
            assert docs.columns == columns
        if number < 3:
            assert docs.exceptAll(before).count() == 0, name
    assert sizes[0] * 0.98 <= sizes[1] <= sizes[0]
    assert sizes[2] < sizes[1] and sizes[3] < sizes[2] and docs.where("NOT intact").count() == 0
    labels = table(spark, SF, "labels")
    clean = labels.where("toxic = 0").count()
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, docs.collect())) and clean


def test_near_copies_stage_keeps_one_of_each_group(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(5, text, "en", "s", 1), (3, text + " more", "en", "s", 1), (3, text + " more", "en", "s", 1), (None, text, "en", "s", 1), (None, "quite alone", None, None, None), (9, None, "en", "s", 0), (8, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_copies(spark, docs, SF).collect()
    # The text without an id that is a near copy of document 3 goes, as the stage's docstring says.
    assert sorted(str(r.doc_id) for r in kept) == ["3", "8", "9", "None"]
    linked = docs.where("text IS NULL OR text <> 'quite alone'")
    assert sorted(str(r.doc_id) for r in corpus_pipeline.near_copies(spark, linked, SF).collect()) == ["3", "8", "9"]


def test_first_stages_keep_clean_documents(spark):
    docs = table(spark, SF, "documents").join(table(spark, SF, "labels").where("toxic = 0").select("doc_id"), "doc_id", "left_semi")
    kept = corpus_pipeline.toxic(spark, corpus_pipeline.language(spark, table(spark, SF, "documents"), SF), SF)
    lost = docs.join(kept.select("doc_id"), "doc_id", "left_anti").count()
    assert lost <= 0.02 * docs.count()
