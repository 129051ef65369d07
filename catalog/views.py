"""The given tables in the roles of raw sources.

documents     source A: the text asks, its source label and the text answer. Exact copies of a text
              under different labels make it matter which copy is kept.
conversations source B: each user turn with the assistant turn right after it, if there is one.
pages         a source without known column names, resolved by position.
benchmark     a source whose first column is a number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.operators import clean_pairs, resolve_pair, union_ordered
from pairloom.plans import clean_and_split
from pairloom.sources import scan


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return scan(spark, f"{sf}/{name}.parquet")


def label_documents(documents: DataFrame) -> DataFrame:
    return documents.select(
        "part",
        "pos",
        F.col("text").alias("instruction"),
        F.concat("source", F.lit(": "), "text").alias("response"),
        F.col("source").alias("category"),
        F.col("lang").alias("intent"),
    )


def a_raw(spark: SparkSession, sf: str) -> DataFrame:
    return label_documents(table(spark, sf, "documents"))


def b_raw(spark: SparkSession, sf: str) -> DataFrame:
    # Joined on conversation and turn, not by a window over the conversation, so that a single
    # very long conversation is spread over tasks like any other.
    turns = table(spark, sf, "conversations")
    replies = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return (
        turns.where("role = 'user'")
        .join(replies, ["conv_id", "turn"], "left")
        .select("part", "pos", F.col("text").alias("question"), "answer")
    )


def b_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Every document again as a later source, equal to source A only once cleaned."""
    return table(spark, sf, "documents").select(
        "part",
        "pos",
        F.concat(F.lit("\u00a0 "), "text", F.lit("\t")).alias("instruction"),
        F.concat(F.lit("B: "), "text").alias("response"),
    )


def c_raw(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("part", "pos", "url", "html")


def d_raw(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select("part", "pos", "item_id", "text")


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    sources = a_raw(spark, sf), resolve_pair(b_raw(spark, sf))
    return union_ordered([clean_pairs(source) for source in sources])


def splits(spark: SparkSession, sf: str) -> DataFrame:
    return clean_and_split([a_raw(spark, sf), resolve_pair(b_raw(spark, sf))])


def named_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Train and validation under the names that preparation expects."""
    return (
        splits(spark, sf)
        .where("split <> 'test'")
        .withColumn("split", F.when(F.col("split") == "val", "validation").otherwise("train"))
    )
