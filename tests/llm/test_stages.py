"""The pipeline's trained stages, its encoding, and the language model's scores, recomputed plainly."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pairloom.llm import langid, lm, toxicity
from pairloom.llm.queries import table

SF = "/root/testdata/sf0.001"
ROWS = [(None, "a clean text without an id", "en", "s", 1, 0.5), (1, None, "en", "s", 1, 0.5), (2, "", "en", "s", 1, 0.5), (3, "12 -- !", "en", None, 1, 0.5), (4, "the text " * 30_000, None, "s", 1, 0.5), (4, "the text again", "en", "s", 1, 0.5)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, lang_score double"


def awkward(spark):
    """The documents with awkward rows, and a column whose name the stages use themselves."""
    docs = table(spark, SF, "documents").withColumn("lang_score", F.lit(0.5))
    return docs.unionByName(spark.createDataFrame(ROWS, SCHEMA))


def ordered(rows):
    return sorted(rows, key=str)


def test_language_stage(spark):
    docs = awkward(spark)
    got = corpus_pipeline.language(spark, docs, SF)
    assert got.columns == docs.columns
    net = langid.fit(docs.select("doc_id", "text", "lang"))
    rows = docs.collect()
    names, scores = langid.classify(net, [r.text for r in rows])
    kept = [tuple(r) for r, name, score in zip(rows, names, scores) if name != "und" and score >= corpus_pipeline.LEAST_LANGUAGE_SCORE]
    assert ordered(map(tuple, got.collect())) == ordered(kept) and 0 < len(kept) < len(rows)
    assert corpus_pipeline.language(spark, docs.limit(0), SF).collect() == []


def test_toxicity_stage(spark):
    docs = awkward(spark)
    got = corpus_pipeline.toxic(spark, docs, SF)
    assert got.columns == docs.columns
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, SF, "labels").select("doc_id", "toxic"))
    kept = [tuple(r) for r in docs.collect() if model.score(r.text) < toxicity.THRESHOLD]
    assert ordered(map(tuple, got.collect())) == ordered(kept) and len(kept) < docs.count()
    assert corpus_pipeline.toxic(spark, docs.limit(0), SF).collect() == []


def test_encoding_stage(spark):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = awkward(spark)
    got = corpus_pipeline.encoded(spark, docs, SF)
    assert got.columns == ["doc_id", "source", "lang", "n_tokens", "token_ids", "intact"]
    wanted = []
    for r in docs.collect():
        ids = model.encode(r.text or "", add_special_tokens=False).ids
        wanted.append((r.doc_id, r.source, r.lang, len(ids), np.array(ids, "<u4").tobytes(), True))
    assert ordered((*r[:4], bytes(r.token_ids), r.intact) for r in got.collect()) == ordered(wanted)
    assert corpus_pipeline.encoded(spark, docs.limit(0), SF).collect() == []


def plain_log10(net, ids, end):
    """Of each id given those before it in its window, one position and one attended id at a time."""
    step, out = lm.WINDOW - lm.OVERLAP, []
    for p in range(len(ids)):
        n = 0
        while not (p < n * step + lm.WINDOW and (n == 0 or p - n * step >= lm.OVERLAP)):
            n += 1
        seen = [end if q == 0 else ids[q - 1] for q in range(n * step, p + 1)]
        rows = [net.tables[net.input_of[i]].astype(float) for i in seen]
        part = lambda row, k: row[k * lm.WIDTH : (k + 1) * lm.WIDTH]
        look = [math.exp(min(60.0, part(rows[-1], 0) @ part(r, 1) / math.sqrt(lm.WIDTH) + float(net.bias[len(rows) - 1 - k]))) for k, r in enumerate(rows)]
        mixed = sum(x / sum(look) * part(r, 2) for x, r in zip(look, rows)) + part(rows[-1], 3)
        logits = np.tanh(mixed) @ net.output[:-1].astype(float) + net.output[-1]
        logits -= logits.max()
        chosen = logits[net.output_of[ids[p]]] - math.log(np.exp(logits).sum())
        out.append(chosen / math.log(10) + net.inside[ids[p]])
    return out


@pytest.mark.parametrize("frequent", [1 << 20, 3])
def test_language_model_scores(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    docs = table(spark, SF, "documents").select("doc_id", "text").limit(60).withColumn("learn", F.col("doc_id") % 3 != 0)
    docs = docs.unionByName(spark.createDataFrame([(900, None, True), (901, "never counted wørds here", False), (902, "one", True)], docs.schema))
    rows = [r for r in docs.collect()]
    model, counts = lm.fit(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), "text", "learn")
    words = lambda t: (t or "").encode().lower().split()
    c = Counter(w for r in rows if r.learn for w in words(r.text))
    ends = sum(r.learn for r in rows)
    scale = sum(c.values()) + ends + 0.5 * (len(c) + 2)
    found = {r.doc_id: r.lm_score for r in lm.score(docs, model, counts).collect()}
    for r in rows[:6] + rows[-3:]:
        spelled = [np.frombuffer(model.spelling[w], np.uint32).tolist() for w in words(r.text)] + [[model.end]]
        scores = plain_log10(model.net, [i for s in spelled for i in s], model.end)
        total, at = 0.0, 0
        for w, s in zip([*words(r.text), None], spelled):
            own = sum(scores[at : at + len(s)])
            at += len(s)
            share = ((ends if w is None else c[w]) + 0.5) / scale
            total += math.log10(model.share * share + (1 - model.share) * 10 ** max(own, -280))
        assert found[r.doc_id] == pytest.approx(total, rel=1e-4, abs=1e-3), r.doc_id


def test_ids_are_counted_over_all_training_documents(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").withColumn("learn", F.col("doc_id") % 5 != 0)
    counts = lm.count_words(docs, "text", "learn")
    spelling = lm.Spelling(lm.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    found = lm.count_ids(counts, spelling)
    wanted = Counter(i for r in docs.where("learn").collect() for w in r.text.encode().lower().split() for i in np.frombuffer(spelling[w], np.uint32).tolist())
    assert {k: int(found[k]) for k in np.flatnonzero(found)} == dict(wanted)


def test_more_languages_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    rows = [(f"{name} text number {k}", name) for name, n in (("a", 9), ("b", 4), ("c", 4), ("d", 4), ("e", 12)) for k in range(n)]
    net = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert net.languages == ["a", "b", "e"]
    many = [(f"text of language {k}", f"l{k:03d}") for k in range(300)]
    monkeypatch.undo()
    assert len(langid.fit(spark.createDataFrame(many, "text string, lang string"), per_language=1).languages) == langid.MAX_LANGUAGES
