"""Mixing sources to target weights by entropy balancing.

Every source gets a target number of words: its weight's share of all words, at most ``most`` times
its own, the excess going to the others by weight. Of all rates at which documents could be
repeated, none above ``most``, those are sought that meet the targets and stay closest, in relative entropy over
documents, to taking each document once. They are exponentially tilted: ``rate = min(most, exp(multiplier * size))``
with one multiplier for each source, so what a source lacks or has too much of is made up by long documents
first. The multipliers maximise the convex dual; Newton's method finds them, all sources at once, each step on sums
over the documents (gathered by source and size first, as equal sizes have equal rates), kept within the bounds that
earlier steps have proved. Rates are then rounded to copies: every document gets the whole part, and of each size, from
the longest to the shortest, as many get a further copy as bring the source's words closest to what the rates ask
for. Of documents of one size those that come first in hash order get it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T, Window

from pairloom.llm.common import fresh, ranked, row_hash, ship, stored
from pairloom.llm.quality import words_of

ship(__name__)

WEIGHTS = (5, 2, 1)
MOST = 3
NEWTON_STEPS = 200
EXACT = 1e-11  # share of the target by which a source's words may miss it before rounding
SLACK = 1e-9
BUCKET_DIGITS = 3  # hexadecimal digits of the hash that name a bucket


def source_targets(
    sources: DataFrame, source: str, size: str, weights: Sequence[int] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """Adds ``target`` to a table of sources with their sizes.

    Sources in order of code points, null last, get the weights in turn. A level is sought such that
    all ``min(most * size, weight * level)`` add up to the total size: sources above their limit are
    set to it and the level is computed anew for the rest, until none is above. Each round is one
    aggregation to three numbers.
    """
    placed = ranked(sources, [F.col(source).isNull(), F.col(source)], "_rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int"))
    weighted = stored(placed.withColumn("_weight", weight.cast("long")), "sources")
    limit = F.lit(most) * F.col(size)
    total = weighted.agg(F.sum(size).alias("n")).head().n or 0
    level, seen = 0.0, -1
    while True:
        above = limit < F.col("_weight") * F.lit(level)
        fixed = weighted.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0)).alias("weight"),
        ).head()
        if fixed.n == seen or not fixed.weight:
            break
        seen, level = fixed.n, (total - fixed.words) / fixed.weight
    target = F.least(limit.cast("double"), F.col("_weight") * F.lit(float(level)))
    return weighted.withColumn("target", target).drop("_rank", "_weight")


def tilts(sizes: DataFrame, sources: DataFrame, most: int = MOST, steps: int = NEWTON_STEPS) -> DataFrame:
    """``source, source_size, target, mean, tilt``: the multipliers, of sizes in units of the source's mean.

    ``sizes`` has ``source, size, n``. The gradient of the dual is the surplus of words under the present rates, the
    Hessian the words of documents below the limit times their size. A step that would leave the bounds known so far
    goes to their middle. Sources that are to be taken whole ``most`` times have a tilt of null, as do those
    without words. If a source has not come to its target after ``steps`` steps, that is an error.
    """
    n, size = F.col("n"), F.col("size")
    means = sizes.groupBy("source").agg((F.sum(n * size) / F.sum(F.when(size > 0, n))).alias("mean")).withColumnRenamed("source", "_s")
    known = sources.join(means, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    full = (F.col("source_size") <= 0) | (F.col("target") >= most * F.col("source_size") * (1 - EXACT))
    none = F.lit(None).cast("double")
    state = known.select("source", "source_size", "target", "mean", F.when(~full, 0.0).alias("tilt"), none.alias("low"), none.alias("high"), full.alias("done"))
    state = stored(state, "tilts")
    for _ in range(steps):
        if state.where("NOT done").head() is None:
            return state.select("source", "source_size", "target", "mean", "tilt")
        now = state.where("NOT done").select(F.col("source").alias("_s"), "tilt", "mean")
        grown = F.exp(F.col("tilt") * size / F.col("mean"))
        below = grown < most
        sums = sizes.join(now, F.col("source").eqNullSafe(F.col("_s"))).groupBy("_s").agg(
            F.sum(n * size * F.least(grown, F.lit(float(most)))).alias("words"),
            F.sum(F.when(below, n * size * size * grown / F.col("mean")).otherwise(0.0)).alias("curve"),
        )
        surplus = F.col("words") - F.col("target")
        step = state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        step = step.withColumn("low", F.when(surplus < 0, F.col("tilt")).otherwise(F.col("low"))).withColumn("high", F.when(surplus > 0, F.col("tilt")).otherwise(F.col("high")))
        newton = F.col("tilt") - surplus / F.when(F.col("curve") > 0, F.col("curve"))
        outside = newton.isNull() | (newton <= F.col("low")) | (newton >= F.col("high"))
        middle = F.coalesce((F.col("low") + F.col("high")) / 2, F.col("high") - 1, F.col("low") + 1)
        met = F.abs(surplus) <= EXACT * F.col("target")
        moved = F.when(F.coalesce(outside, F.lit(False)), middle).otherwise(newton)
        state = stored(
            step.select("source", "source_size", "target", "mean", F.when(F.col("done") | met, F.col("tilt")).otherwise(moved).alias("tilt"), "low", "high", (F.col("done") | F.coalesce(met, F.lit(False))).alias("done")),
            "tilts",
        )
    raise ArithmeticError(f"a source's words do not come to its target within {steps} steps")


def _rounded(sizes: pa.Table) -> pa.Table:
    """Adds to each size of a source the whole part of its rate, and how many documents get a further copy.

    From the longest documents to the shortest, each size takes as many as bring the words so far closest to
    those that the rates ask for, so that shorter ones make up for what the longer ones miss.
    """
    size, n, rate = (sizes.column(c).to_numpy().astype(float) for c in ("size", "n", "rate"))
    whole = np.floor(rate + SLACK)
    share = np.where((rate - whole > SLACK) & (size > 0), rate - whole, 0.0) * n
    due, carry = np.zeros(len(size), np.int64), 0.0
    for k in np.argsort(-size, kind="stable"):
        if size[k] > 0:
            carry += share[k] * size[k]
            due[k] = min(max(math.floor(carry / size[k] + 0.5), 0), n[k]) if share[k] > 0 else 0
            carry -= due[k] * size[k]
    return sizes.append_column("whole", pa.array(whole.astype(np.int64))).append_column("due", pa.array(due))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    carry: bool = False,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies`` of every document, and with ``carry`` its ``row``.

    Size is in words; a null text has none. A null source is a source of its own. Repeated rows are
    documents of their own. An empty table gives an empty result; documents without words are taken once, in
    a source without words not at all. Which documents get a further copy depends on ids and sizes only, so reruns
    agree; of documents of equal id and size all or none get it. With ``carry`` the whole row is a struct that
    goes along, and rows without an id are ordered by their content.
    """
    words, order = fresh(docs, "_words", "_order")
    whole_row = [F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if carry else []
    unnamed = F.hex(row_hash(*docs.columns)) if carry else F.lit("")
    drawn = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), unnamed), F.lit("|"), F.size(words).cast("string")))
    sized = docs.select("*", words_of(F.coalesce(text, F.lit(""))).alias(words)).select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.size(words).cast("long").alias("size"), drawn.alias(order), *whole_row
    )
    sized = stored(sized, "sizes")
    narrow = sized.select("source", "size", F.col(order).alias("place"), F.conv(F.left(order, F.lit(BUCKET_DIGITS)), 16, 10).cast("int").alias("bucket"))

    # Rows by source, size and bucket; everything but the cuts is decided on these counts.
    counts = stored(narrow.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n")), "counts")
    sizes = stored(counts.groupBy("source", "size").agg(F.sum("n").alias("n")), "sizes-by-source")
    of_source = sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    tilted = tilts(sizes, source_targets(of_source, "source", "source_size", weights, most), most)
    tilted = tilted.withColumnRenamed("source", "_s")
    grown = F.least(F.exp(F.col("tilt") * F.col("size") / F.col("mean")), F.lit(float(most)))
    full = F.when(F.col("source_size") > 0, F.when(F.col("size") > 0, float(most)).otherwise(1.0)).otherwise(0.0)
    rated = sizes.join(tilted, F.col("source").eqNullSafe(F.col("_s"))).select(
        "source", "size", "n", "source_size", "target", F.coalesce(grown, full).alias("rate")
    )
    rated = stored(rated, "rates")
    rated = stored(rated.groupBy("source").applyInArrow(_rounded, T.StructType([*rated.schema.fields, T.StructField("whole", T.LongType()), T.StructField("due", T.LongType())])), "rounded")

    # Where in hash order the last of them stands: its bucket by the counts, then its place within the bucket.
    upto = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    passed = counts.withColumn("passed", F.coalesce(F.sum("n").over(upto), F.lit(0))).alias("c")
    wanted = rated.where("due > 0").select("source", "size", "due").alias("w")
    edges = passed.join(wanted, F.expr("c.source <=> w.source AND c.size = w.size AND passed < due AND passed + n >= due"))
    edges = stored(edges.select("c.source", "c.size", "bucket", (F.col("due") - F.col("passed")).alias("left")), "edges").alias("e")
    place = F.row_number().over(Window.partitionBy("d.source", "d.size", "d.bucket").orderBy("place"))
    at_edge = narrow.alias("d").join(edges, F.expr("d.source <=> e.source AND d.size = e.size AND d.bucket = e.bucket"))
    cuts = at_edge.withColumn("number", place).where("number = left").select("d.source", "d.size", F.col("place").alias("cut"))
    plan = rated.alias("r").join(cuts.alias("k"), F.expr("r.source <=> k.source AND r.size = k.size"), "left")
    plan = stored(plan.select(F.col("r.source").alias("_s"), F.col("r.size").alias("_z"), "source_size", "target", "rate", "whole", "cut"), "plan")
    more = (F.col("cut").isNotNull() & (F.col(order) <= F.col("cut"))).cast("long")
    return sized.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))).select(
        "doc_id", "source", "size", "source_size", "target", "rate", (F.col("whole") + more).cast("long").alias("copies"), *(["row"] if carry else [])
    )


def report(docs: DataFrame) -> DataFrame:
    """What the mix takes of each document, in words."""
    return mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def apply_mix(docs: DataFrame) -> DataFrame:
    """Each row as often as the mix takes it. Rows go through the mix whole, so ids may be null or repeat."""
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mix(docs, carry=True).where("copies > 0").select("row", copies).select("row.*")


# The same results in DuckDB: the level from sorted limits, the tilts by Newton steps of its own.
ORACLE_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
o AS (SELECT *, md5(coalesce(doc_id::VARCHAR, '') || '|' || size) AS ord FROM sized),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
    (SELECT sum(source_size) FROM s)::BIGINT AS total FROM s),
c AS (
  SELECT *, coalesce(sum(3 * source_size) OVER b, 0)::BIGINT AS fixed,
    (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::BIGINT AS free
  FROM w WINDOW b AS (ORDER BY 3.0::DOUBLE * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT (total - fixed)::DOUBLE / free AS level FROM c
  WHERE 3 * source_size >= weight * ((total - fixed)::DOUBLE / free)
  ORDER BY 3.0::DOUBLE * source_size / weight, source LIMIT 1),
h AS (SELECT source, size, count(*) AS n FROM sized GROUP BY ALL),
m AS (SELECT source, sum(n * size)::DOUBLE / sum(n) AS mean FROM h WHERE size > 0 GROUP BY source),
t AS (
  SELECT w.source, source_size, least((3 * source_size)::DOUBLE, weight * level) AS target, mean
  FROM w CROSS JOIN l LEFT JOIN m ON m.source IS NOT DISTINCT FROM w.source),
newton AS (
  SELECT 0 AS step, source, target, mean, 0::DOUBLE AS tilt, NULL::DOUBLE AS low, NULL::DOUBLE AS high
  FROM t WHERE source_size > 0 AND target < 3 * source_size * (1 - 1e-11::DOUBLE)
  UNION ALL
  SELECT step + 1, source, target, mean,
    CASE WHEN abs(surplus) <= 1e-11 * target THEN tilt
         WHEN next IS NULL OR next <= lo OR next >= hi THEN coalesce((lo + hi) / 2, hi - 1, lo + 1) ELSE next END, lo, hi
  FROM (SELECT *, tilt - surplus / nullif(curve, 0) AS next,
          CASE WHEN surplus < 0 THEN tilt ELSE low END AS lo, CASE WHEN surplus > 0 THEN tilt ELSE high END AS hi
        FROM (SELECT step, k.source, target, mean, tilt, low, high,
                sum(n * size * least(exp(tilt * size / mean), 3.0::DOUBLE)) - target AS surplus,
                sum(CASE WHEN exp(tilt * size / mean) < 3 THEN n * size * size * exp(tilt * size / mean) / mean ELSE 0 END) AS curve
              FROM newton k JOIN h ON h.source IS NOT DISTINCT FROM k.source
              WHERE step < 60 GROUP BY step, k.source, target, mean, tilt, low, high))),
r AS (
  SELECT h.source, h.size, h.n, t.source_size, t.target,
    coalesce(least(exp(k.tilt * h.size / k.mean), 3.0::DOUBLE), CASE WHEN t.source_size = 0 THEN 0 WHEN h.size > 0 THEN 3 ELSE 1 END) AS rate
  FROM h JOIN t ON h.source IS NOT DISTINCT FROM t.source
  LEFT JOIN (SELECT * FROM newton WHERE step = 60) k ON k.source IS NOT DISTINCT FROM h.source),
f AS (
  SELECT *, floor(rate + 1e-9) AS whole,
    CASE WHEN size > 0 AND rate - floor(rate + 1e-9) > 1e-9 THEN rate - floor(rate + 1e-9) ELSE 0 END * n AS share FROM r),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC) AS k FROM f WHERE size > 0),
fold AS (
  SELECT 0 AS k, source, 0::DOUBLE AS carry, 0::DOUBLE AS due FROM t
  UNION ALL
  SELECT k, source, asked - size * due, due
  FROM (SELECT p.k, p.source, p.size, carry + share * p.size AS asked,
          CASE WHEN share > 0 THEN least(greatest(floor((carry + share * p.size) / p.size + 0.5), 0), p.n) ELSE 0 END AS due
        FROM fold JOIN p ON p.source IS NOT DISTINCT FROM fold.source AND p.k = fold.k + 1)),
d AS (
  SELECT o.doc_id, o.size, f.source_size, f.target, f.whole, coalesce(fold.due, 0) AS due,
    row_number() OVER (PARTITION BY o.source, o.size ORDER BY ord) AS place
  FROM o JOIN f ON o.source IS NOT DISTINCT FROM f.source AND o.size = f.size
  LEFT JOIN p ON p.source IS NOT DISTINCT FROM o.source AND p.size = o.size
  LEFT JOIN fold ON fold.source IS NOT DISTINCT FROM p.source AND fold.k = p.k)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN place <= due THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d
"""
