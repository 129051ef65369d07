"""Trained models: gradients, held-out accuracy, exact base scores, awkward rows."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pairloom.llm import langid, lm, toxicity
from pairloom.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.01"
AWKWARD = [(1, None, "en", 1), (None, "", None, 0), (2, " \n!", "en", None), (3, "word " * 40000, "en", 0), (3, "word", "en", 7)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, "doc_id long, text string, lang_pred string, toxicity int")


def slope_errors(weights, slopes, loss, draw, number=6):
    for weight, slope in zip(weights, slopes):
        for _ in range(number):
            at = tuple(int(draw.integers(0, n)) for n in weight.shape)
            kept = weight[at]
            weight[at] = kept + 1e-4
            above = loss()
            weight[at] = kept - 1e-4
            below = loss()
            weight[at] = kept
            yield abs((above - below) / 2e-4 - slope[at])


def test_backpropagation_through_time():
    net = langid.ByteGru.new(["a", "b", "c"], hidden=3)
    net.inputs, net.recurrent, net.output = (w.astype(float) for w in (net.inputs, net.recurrent, net.output))
    draw = np.random.default_rng(0)
    steps, target, mask = draw.integers(97, 105, (12, 5)), draw.integers(0, 3, 5), draw.random((12, 5)) > 0.2
    _, slopes = langid.gradients(net, steps, target, mask)
    loss = lambda: langid.gradients(net, steps, target, mask)[0]
    assert max(slope_errors((net.inputs, net.recurrent, net.output), slopes, loss, draw)) < 1e-6


def test_windows_label_every_position_once():
    texts = [b"", b"x" * 5, b"y" * langid.SPAN, b"z" * 1000]
    cut = langid.cut_windows(texts)
    _, counted = langid.fill_windows(cut, slice(0, len(cut[3])))
    assert np.bincount(cut[3], weights=counted.sum(axis=0), minlength=4).tolist() == [len(t) for t in texts]


def test_language_held_out(spark):
    truth = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op10_langid"](spark, SF).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_language_of_awkward_rows(spark, awkward):
    net = langid.fit(awkward.select("text", F.col("lang_pred").alias("lang")))
    rows = langid.identify(awkward, net)
    assert rows.columns == [*awkward.columns, "lang_pred_", "lang_score"]
    assert Counter(r.lang_pred_ for r in rows.collect()) == {"und": 3, "en": 2}
    nothing = langid.fit(awkward.limit(0).select("text", F.lit("x").alias("lang")))
    assert {r.lang_pred_ for r in langid.identify(awkward, nothing).collect()} == {"und"}
    assert langid.identify(awkward.limit(0), net).count() == 0


def test_label_model_finds_who_is_right():
    """Voters of known accuracy, two of them copies of each other."""
    draw = np.random.default_rng(1)
    truth = draw.random(4000) < 0.3
    votes = [np.where(draw.random(4000) < toxicity.ANNOTATORS, truth, ~truth) * 2 - 1]
    for accuracy in (0.9, 0.6):
        right = draw.random(4000) < accuracy
        votes.append(np.where(draw.random(4000) < 0.5, np.where(right, truth, ~truth) * 2 - 1, 0))
    votes.append(votes[1].copy())
    model = toxicity.fit_label_model(np.stack(votes, axis=1), np.where(votes[0] > 0, 0.9, 0.05), 0.3)
    assert model.gain[1, 1] > model.gain[2, 1] > 0 > model.gain[2, 0] > model.gain[1, 0]
    assert model.say[1] < 0.8 and model.say[0] == 1
    assert ((model.posterior(np.stack(votes, axis=1)) > 0.5) == truth).mean() > 0.97


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    rows = [r for r in QUERIES["op5_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert all(r.predicted == (r.score >= 0.3) and zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    found = [r.predicted for r in rows if labels[r.doc_id] == 1]
    false = [r.predicted for r in rows if labels[r.doc_id] == 0]
    assert np.mean(found) > 0.9 and np.mean(false) < 0.01


def test_toxicity_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, None), (9, 1), (None, 1)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0), labels.where("doc_id = 9")):
        model = toxicity.fit(awkward, some)
        rows = toxicity.score(awkward, model)
        assert rows.columns == [*awkward.columns, "toxicity_", "toxic_predicted"]
        assert all(0 <= r.toxicity_ <= 1 for r in rows.collect()) and rows.count() == len(AWKWARD)


def test_attention_windows_score_every_id_once():
    lengths = np.array([1, 5, lm.WINDOW, lm.WINDOW + 1, 100])
    at, counted, _ = lm.lay_out(np.zeros(lengths.sum(), int), lengths)
    assert sorted(at[counted].tolist()) == list(range(lengths.sum()))


def test_attention_is_causal_and_sums_to_one():
    ids = np.random.default_rng(2).integers(0, 300, 400)
    net = lm.new_network(ids, 300)
    lengths = np.array([100, 300])
    first = lm.score_ids(net, ids, lengths, 0)
    changed = ids.copy()
    changed[50:100] = 7
    assert np.allclose(first[:50], lm.score_ids(net, changed, lengths, 0)[:50], atol=1e-5)
    total = sum(10.0 ** lm.score_ids(net, np.array([4, 9, k]), np.array([3]), 0)[2] for k in range(300))
    assert total == pytest.approx(1, abs=1e-3)
    trained = lm.train(lm.new_network(ids, 300), ids, lengths, 0, epochs=30)
    assert lm.score_ids(trained, ids, lengths, 0).sum() > first.sum()


def words(text):
    return (text or "").encode().lower().split()


def check_base(rows, docs, learned):
    c = Counter(w for i, t in docs if learned(i) for w in words(t))
    ends = sum(1 for i, _ in docs if learned(i))
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    share = lambda k: math.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    wanted = Counter()
    for i, t in docs:
        ws = words(t)
        wanted[i, len(ws) + 1, sum(c[w] > 0 for w in ws) + (ends > 0), round(sum(share(c[w]) for w in ws) + share(ends), 4)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in rows) == wanted
    return n


def test_lm_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    rows = QUERIES["op7_lm"](spark, SF).collect()
    learned = lambda i: zlib.crc32(str(i).encode()) % 5 != 1
    assert check_base(rows, docs, learned) == rows[0].train_tokens
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.held_out != learned(r.doc_id) for r in rows)


def test_lm_of_awkward_rows(spark, awkward, monkeypatch):
    docs = awkward.withColumn("learn", F.lit(True)).withColumnRenamed("toxicity", "n_tokens")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    monkeypatch.setattr(lm, "FREQUENT", 2)  # nearly every word goes through the join
    model, counts = lm.fit(docs, path, "text", "learn")
    out = lm.score(docs, model, counts)
    assert "n_tokens_" in out.columns and "text" not in out.columns
    check_base(out.drop("n_tokens").withColumnRenamed("n_tokens_", "n_tokens").collect(), [r[:2] for r in AWKWARD], lambda i: True)
    empty, none = lm.fit(docs.limit(0), path, "text", "learn")
    assert lm.score(docs.limit(0), empty, none).count() == 0
    assert all(math.isfinite(r.lm_score) for r in lm.score(docs, empty, none).collect())
