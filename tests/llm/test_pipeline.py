"""Stages of the pipeline against plain recomputation from their own input."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from pairloom.llm import bpe, jaccard

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def groups(texts, width=5, percent=80):
    """Number of each text's component, all pairs being compared."""
    sets = [shingles(t, width) for t in texts]
    group = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    return group


def near_texts():
    """Groups of texts around both limits: of 5 words at 80 and of 4 words at 85 percent."""
    draw = random.Random(12)
    texts = []
    for length in (3, 5, 20, 60, 100, 100, 100, 150, 300):
        base = [f"w{draw.randrange(10**6)}" for _ in range(length)]
        texts.append(" ".join(base))
        for changes in (1, 2, 2, 3, 4):
            other = list(base)
            for k in draw.sample(range(length), min(changes * max(1, length // 100), length)):
                other[k] = f"x{draw.randrange(10**6)}"
            texts.append(" ".join(other))
    return texts


def test_near_copies_stage_links_at_its_own_limit(spark):
    base = [f"w{k}" for k in range(100)]
    two = [*base[:30], "x", *base[31:60], "y", *base[61:]]  # 86 of 106 shingles of 5 words, 89 of 105 of 4
    texts = [" ".join(base), " ".join(two), *near_texts()]
    assert groups(texts[:2]) == [0, 0] and groups(texts[:2], 4, 85) == [0, 1]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], SCHEMA)
    kept = sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect())
    group = groups(texts)
    assert kept == sorted({g: k for k, g in reversed(list(enumerate(group)))}.values())


def test_index_never_loses_a_link_at_80_percent():
    bands, draw = jaccard.Bands.of(80), np.random.default_rng(6)
    for size in (5, 6, 13, 47, 106, 301):
        for _ in range(40):
            union = np.unique(draw.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
            differ = len(union) * 20 // 100
            gone = draw.permutation(len(union))[:differ]
            cut = draw.integers(0, differ + 1)
            a, b = np.delete(union, gone[:cut]), np.delete(union, gone[cut:])
            frequent = np.sort(draw.permutation(union)[: draw.integers(0, len(union) + 1)])
            shared = np.intersect1d(jaccard.index_entries(a, bands, frequent), jaccard.index_entries(b, bands, frequent))
            assert len(shared) or np.array_equal(a, b)


def test_null_and_repeated_ids(spark):
    texts = near_texts()[6:24]
    ids = [None, 7, None, 3] * len(texts)
    rows = [(ids[k], t, "en", "ab"[k % 2], len(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    best = {}
    for row, g in zip(rows, groups(texts)):
        best[g] = min(best.get(g, (True, 0)), (row[0] is None, row[0] or 0))
    kept = corpus_pipeline.near_copies(spark, docs, "").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == sorted(best.values())
    assert len({r.text for r in kept}) == len(best)


def test_mixing_takes_rows_without_ids_one_by_one(spark):
    rows = [(None if k % 3 else 5, f"w{k} " * 10, "en", "s", 1) for k in range(60)]
    taken = corpus_pipeline.mixed(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(r.text for r in taken) == sorted(t for _, t, *_ in rows)  # a single source is taken once


def test_language_stage_without_any_language(spark):
    texts = ["a clean text", "12 34 !", "", None, "\u00e9t\u00e9"]
    docs = spark.createDataFrame([(k, t, None, "s", 1) for k, t in enumerate(texts)], SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()) == [0, 4]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_hand_rows_to_python_in_small_lots(spark, monkeypatch, name):
    """Also when a stage's rows are read, after it has returned."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    monkeypatch.setattr(corpus_pipeline, "LOT_BYTES", 1 << 15)
    monkeypatch.setattr(corpus_pipeline, "_table", lambda spark, sf_dir, name: spark.createDataFrame([], "doc_id long, toxic int"))
    texts = [" ".join(f"word{k * j}" for j in range(500)) for k in range(60)]
    docs = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in enumerate(texts)], SCHEMA).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    try:
        dict(corpus_pipeline.STAGES)[name](spark, docs, "")
        seen = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    finally:
        spark.conf.set(setting, before)
    assert sum(seen) > 3 * (1 << 15) and max(seen) < 2 * (1 << 15)


def test_tokens_do_not_depend_on_the_word_cache(spark, monkeypatch):
    texts = [" ".join(f"w{k} x{j % 7}" for j in range(40)) for k in range(30)] + ["", None]
    docs = spark.createDataFrame([(k, t, "en", "a", 0) for k, t in enumerate(texts)], SCHEMA)
    stage = dict(corpus_pipeline.STAGES)["BPE"]
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    try:
        whole = sorted(map(tuple, stage(spark, docs, "").collect()))
        monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
        monkeypatch.setattr(bpe, "TABLE_ARCS", 3)
        assert sorted(map(tuple, stage(spark, docs, "").collect())) == whole
    finally:
        spark.conf.set(setting, before)
    assert all(r[-1] for r in whole)
