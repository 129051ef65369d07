"""From raw tables to clean, unique instruction/response pairs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pairloom.functions.text import as_text, clean_text, has_visible_text
from pairloom.operators.order import ORDER


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns (and the order columns present); a missing one is an error."""
    return df.select(*[c for c in ORDER if c in df.columns], *columns)


def tag(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def _raw_text(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit("")
    dtype = df.schema[name].dataType
    # A null needs no replacement: the filter removes it.
    return F.col(name) if isinstance(dtype, T.StringType) else as_text(name, dtype)


def clean_pairs(
    df: DataFrame, instruction: str = "instruction", response: str = "response"
) -> DataFrame:
    """Cleaned ``instruction, response`` of the rows where both are non-empty.

    Rows are chosen on the raw text, so the cleaning expressions appear once in the plan, and a
    query that needs only the instruction never cleans the response.
    """
    left, right = _raw_text(df, instruction), _raw_text(df, response)
    return df.where(has_visible_text(left) & has_visible_text(right)).select(
        *[c for c in ORDER if c in df.columns],
        clean_text(left).alias("instruction"),
        clean_text(right).alias("response"),
    )


def union_ordered(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL that remembers which frame a row came from, in ``src_rank``."""
    ranked = []
    for rank, frame in enumerate(frames):
        if "part" not in frame.columns:
            frame = frame.withColumn("part", F.lit(""))
        ranked.append(frame.withColumn("src_rank", F.lit(rank)))
    return reduce(DataFrame.unionByName, ranked)


def dedup_keep_first(
    df: DataFrame, key: str = "instruction", order_cols: Sequence[str] = ORDER
) -> DataFrame:
    """For each key the row that comes first in ``order_cols``.

    Spark keeps one row per key and task before the shuffle, so the copies of a hot key never
    meet in one task.
    """
    copies = Window.partitionBy(key).orderBy(*order_cols)
    return df.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy")
