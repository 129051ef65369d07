"""Row counts along the way. All aggregate before the shuffle, so hot groups do no harm."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def count_raw_by_source(df: DataFrame, source: str = "source") -> DataFrame:
    """Rows per source, to be taken before empty pairs are dropped."""
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("n_rows"))


def pair_counts(pairs: DataFrame, key: str = "instruction") -> DataFrame:
    """One row: pairs ``loaded``, ``unique`` instructions and duplicates ``removed``.

    The texts are counted by digest, which keeps them out of the shuffle.
    """
    copies = pairs.groupBy(F.unhex(F.sha2(key, 256)).alias("digest")).agg(
        F.count(F.lit(1)).alias("n")
    )
    loaded, unique = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return copies.agg(
        loaded.alias("loaded"), unique.alias("unique"), (loaded - unique).alias("removed")
    )


def count_by_split(df: DataFrame, names: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """Rows per expected split, 0 for one without rows."""
    counted = df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    one = df.sparkSession.range(1, numPartitions=1)
    expected = one.select(F.explode(F.array(*map(F.lit, names))).alias("split"))
    return expected.join(counted, "split", "left").select(
        "split", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )
