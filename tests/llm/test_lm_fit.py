"""What the language model is fitted to."""

from __future__ import annotations

import random

import public_tokenizers
from pyspark.sql import functions as F

from pairloom.llm import lm

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def some_docs(spark, number=60):
    draw = random.Random(3)
    words = [f"word{k}" for k in range(400)]
    rows = [(k, " ".join(words[min(399, int(draw.expovariate(0.01)))] for _ in range(40))) for k in range(number)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("learn", F.col("doc_id") % 10 > 0).repartition(3, "doc_id")


def test_share_does_not_depend_on_what_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lm, "DEV_DOCS", 1200)
    docs = some_docs(spark)
    whole, _ = lm.fit(docs, PATH, "text", "learn")
    monkeypatch.setattr(lm, "FREQUENT", 2)
    joined, _ = lm.fit(docs, PATH, "text", "learn")
    assert len(joined.frequent) < len(whole.frequent) and joined.share == whole.share


def test_every_training_document_is_learned_from_once(spark, monkeypatch):
    monkeypatch.setattr(lm, "SAMPLE_DOCS", 6)
    monkeypatch.setattr(lm, "DEV_DOCS", 1)
    monkeypatch.setattr(lm, "SHARD_DOCS", 9)
    begun, met = [], []
    train, learn_round = lm.train, lm.learn_round
    monkeypatch.setattr(lm, "train", lambda net, ids, lengths, end: begun.append(lengths) or train(net, ids, lengths, end))

    def noted(docs, *others):
        rows = learn_round(docs, *others)
        met.append((docs.select("_t").collect(), rows))
        return rows

    monkeypatch.setattr(lm, "learn_round", noted)
    docs = some_docs(spark)
    docs = docs.unionAll(docs.where("doc_id in (1, 2)"))  # repeated rows are learned from as often
    model, _ = lm.fit(docs, PATH, "text", "learn")
    assert len(met) == lm.ROUNDS
    learned = [len(r._t.split()) for some, _ in met for r in some]
    assert len(begun[0]) + len(learned) == docs.where("learn").count()
    # The end is an id of each document's own, so what the shards met tells what they have read: the id before
    # a document's first is the end.
    end = int(model.net.input_of[model.end])
    ends = sum(rows.where(F.col("row") == end).agg(F.sum("met").alias("n")).head().n for _, rows in met)
    assert ends >= len(learned)


def test_weights_and_share_follow_documents_beyond_the_first(spark, monkeypatch):
    monkeypatch.setattr(lm, "SAMPLE_DOCS", 5)
    monkeypatch.setattr(lm, "DEV_DOCS", 1)
    monkeypatch.setattr(lm, "SHARD_DOCS", 20)
    docs = some_docs(spark).where("learn")
    model, _ = lm.fit(docs, PATH, "text", "learn")
    parts = docs.repartition(5, "text")
    again, _ = lm.fit(parts, PATH, "text", "learn")
    assert abs(model.net.tables - again.net.tables).max() < 1e-4 and model.share == again.share
    monkeypatch.setattr(lm, "learn_round", None)
    monkeypatch.setattr(lm, "ROUNDS", 0)
    begun, _ = lm.fit(docs, PATH, "text", "learn")
    texts = [lm.words_of(r.text) for r in docs.collect()]
    total = lambda m: sum(s.sum() for s in m.spelled(texts))
    assert total(model) > total(begun)
