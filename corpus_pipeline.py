"""A corpus pipeline of five stages, each over everything that the one before kept."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import bpe, jaccard, langid, mixing, toxicity
from pairloom.llm.common import fresh, row_hash, stored

LEAST_LANGUAGE_SCORE = 0.4
# The stage has no contract of its own for near copies; op6's 4 words and 85 percent bind only op6.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
# Bytes of rows that go to Python at a time. The JVM and Python both hold a lot for every running task, and by default it has 64 MB.
LOT_BYTES = 4 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def small_lots(stage: Stage) -> Stage:
    """The stage in a session that hands rows to Python in lots of ``LOT_BYTES``.

    A stage's rows are computed when they are read, after it has returned, so the session keeps the setting.
    """

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(LOT_BYTES))
        return stage(spark, docs, sf_dir)

    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@small_lots
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, and those of which no language has a share to speak of.

    Null and empty texts have no letter. Rows with a null or repeated id are judged like any other, columns
    beyond those of documents stay, whatever their names, and an empty table stays empty. If no document has a language, nothing can be learned, and all texts that hold a letter stay.
    """
    net = langid.fit(docs.select("doc_id", "text", "lang"))
    if not net.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    known = langid.identify(docs, net)
    name, score = known.columns[-2:]
    kept = (F.col(name) != langid.UNDETERMINED) & (F.col(score) >= LEAST_LANGUAGE_SCORE)
    return known.where(kept).select(*docs.columns)


@small_lots
def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that the classifier calls toxic; it is learned from the labels of these documents.

    Null and empty texts have no toxic words and stay; a null id has no label. Repeated rows are judged alike, all
    columns stay, whatever their names, and an empty table stays empty.
    """
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs.select("doc_id", "text"), labels))
    return scored.where(F.col(scored.columns[-1]) == 0).select(*docs.columns)


@small_lots
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each component the document with the smallest id.

    Documents link from 80 percent of their 5-word shingles.

    Rows are told apart by a stored key, so one row stays of each component, whatever ids are null or
    repeated: the smallest id first, null last, then by content. What links with nothing stays.
    """
    (key,) = fresh(docs, "_key")
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    groups = jaccard.near_copies(rows, key, percent=SIMILAR_PERCENT, width=SHINGLE_WORDS)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), row_hash(*docs.columns).alias("content"), F.col(key).alias("key"))
    placed = rows.select(key, order.alias("_order")).join(groups.select(F.col("doc_id").alias(key), "component_id"), key)
    first = placed.groupBy("component_id").agg(F.min("_order").alias("_order")).select(F.col("_order.key").alias(key))
    return rows.join(first, key, "left_semi").select(*docs.columns)


@small_lots
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with all columns; an empty table stays empty.

    Null sources are one source. Documents without words are taken once, or not at all in a source without any.
    """
    return mixing.apply_mix(docs)


@small_lots
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix, checked by decoding them: ``doc_id, source, lang, n_tokens, token_ids,
    intact``. Null and empty texts have no tokens; repeated rows stay, and an empty table gives no rows."""
    tokens = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    count, ids, back = tokens.columns[-3:]
    intact = F.coalesce(F.col("text"), F.lit("")) == F.col(back)
    return tokens.select("doc_id", "source", "lang", F.col(count).alias("n_tokens"), F.col(ids).alias("token_ids"), intact.alias("intact"))


STAGES = [
    ("language ID", language),
    ("toxicity", toxic),
    ("n-gram Jaccard join", near_copies),
    ("mixing", mixed),
    ("BPE", encoded),
]

#: Trained models cannot be expressed in SQL; tests/llm/test_pipeline.py and test_stages.py use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's result is stored before the next one reads it."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
