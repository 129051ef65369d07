"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.llm.common import ship, stored

ship(__name__)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of every node that has a link; the component is its smallest node.

    Large stars link each node's larger neighbours to its smallest one, small stars its smaller ones,
    until every node is linked to its component's smallest only. A step looks up one minimum per node,
    which is aggregated before the shuffle, so that no node's neighbours are ever brought together. Links
    with a null or to the node itself do not count.
    """
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).distinct()
    edges, before = stored(edges, "links"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("x"), "m"), F.struct(F.col("u").alias("x"), "m"))).alias("e")
        )
        small = small.select(F.greatest("e.x", "e.m").alias("u"), F.least("e.x", "e.m").alias("v"))
        edges = stored(small.where("u <> v").distinct(), "links")
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
        ).head()
        if state == before:
            break
        before = state
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
