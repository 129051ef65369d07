"""The registered queries of the corpus operators, over whole tables of the given folder."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import bpe, jaccard, langid, licenses, lines, lm, mixing, neighbours, phrases, quality, toxicity, urlfilter, variants
from pairloom.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(table(spark, sf, "documents"), tokenizer)


@query
def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.verdicts(table(spark, sf, "documents"))


ORACLE["op8_quality"] = quality.ORACLE_SQL


@query
def op10_langid(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held = held_out("doc_id", 3, 1)
    net = langid.fit(docs.where(~held))
    found = langid.identify(docs.select("doc_id", "text", held.alias("held_out")), net)
    return found.select(
        "doc_id", "held_out", "lang_pred", found.lang_score.alias("score")
    )


@query
def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.report(table(spark, sf, "documents"))


ORACLE["op3_mixing"] = mixing.ORACLE_SQL


@query
def op9_urls(spark: SparkSession, sf: str) -> DataFrame:
    return urlfilter.verdicts(table(spark, sf, "pages"))


ORACLE["op9_urls"] = urlfilter.ORACLE_SQL


@query
def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held = held_out("doc_id", 4, 2)
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.where(~held))
    scored = toxicity.score(docs.withColumn("held_out", held), model)
    return scored.select(
        "doc_id", "held_out", scored.toxicity.alias("score"), scored.toxic_predicted.alias("predicted")
    )


@query
def op7_lm(spark: SparkSession, sf: str) -> DataFrame:
    learn = ~held_out("doc_id", 5, 1)
    docs = table(spark, sf, "documents").select("doc_id", "text").withColumn("learn", learn)
    model, counts = lm.fit(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), "text", "learn")
    scored = lm.score(docs, model, counts)
    return scored.select(
        "doc_id",
        (~scored.learn).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        scored.lm_score.alias("score"),
    )


@query
def op6_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_copies(table(spark, sf, "documents"))


@query
def op2_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)


if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


@query
def op4_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents").select("doc_id", "text")).drop("text")


@query
def op11_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.mine(table(spark, sf, "documents").select("lang", "text"))


ORACLE["op11_phrases"] = phrases.ORACLE_SQL


@query
def op12_variants(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return variants.group_variants(variants.count_words(docs, slip_every=199))


@query
def op13_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    dropped = lines.drop_repeated(docs, lines.index_lines(docs))
    return dropped.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE["op13_lines"] = lines.ORACLE_SQL
