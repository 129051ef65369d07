"""Nearest neighbours by largest inner product, with a hash-prefix forest.

Equal vectors are one class, so a vector that is repeated any number of times is searched once. Every
class has a long hash string in each tree; the symbols of a string are the corners of a randomly turned
cross-polytope that the vector is nearest to. As the largest inner product is wanted, not the smallest
angle, data vectors get one more component that makes them equally long, and queries a zero there. A
tree is its strings in order: those that share a prefix with a query stand next to each other.

A query descends all trees to where the longest prefixes match, and ascends them together, one symbol at
a time, until the prefixes it shares have enough strings under them; on the last level it takes tree after
tree until they are enough. How many are enough grows with the number of classes, ``CANDIDATES * n **
GROWTH``: on vectors without structure a fixed number would find ever less. Where as many as there are
would be wanted, the root is, and the search is exact. Strings are counted by prefix and looked up by prefix; the strings
under one prefix, and the queries that look there, are dealt out in blocks, and a block of either is compared by
one matrix product, of which each query keeps its nearest only, however many tie.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pairloom.llm.common import ship, stored

ship(__name__)

TREES = 80
SYMBOLS = 3  # length of a hash string
CORNERS = 64  # axes of the cross-polytope; each gives two symbols
CANDIDATES = 2.4
GROWTH = 0.83
BLOCK = 4096  # strings under a prefix, and queries, that are compared together
NEAREST = 20


def turns(tree: int, size: int) -> np.ndarray:
    """The random turns of one tree: (size, symbols * corners)."""
    return np.random.default_rng([tree, size]).standard_normal((size, SYMBOLS * CORNERS)).astype(np.float32)


def hash_strings(vectors: np.ndarray, tree: int) -> np.ndarray:
    """(number, symbols) bytes: the nearest corner in each turn."""
    turned = (vectors @ turns(tree, vectors.shape[1])).reshape(len(vectors), SYMBOLS, CORNERS)
    axis = np.abs(turned).argmax(axis=2)
    positive = np.take_along_axis(turned, axis[:, :, None], axis=2)[:, :, 0] > 0
    return (2 * axis + positive).astype(np.uint8)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(v, np.float64) for v in column.to_pylist()])


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Rows that take part: with an id, and a vector without nulls, of finite numbers, not all 0."""
    v = F.col(vector)
    number = lambda x: x.cast("double")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: number(x) != 0)
    rows = vectors.where(F.col(vec_id).isNotNull() & v.isNotNull() & fine & some)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(v, number).alias("vector"))


def _strings(classes: DataFrame, longest: DataFrame) -> DataFrame:
    """``class, asks, tree, string``: strings of data, and of queries as queries.

    ``itself`` says of a query how many symbols its own string as data begins with.
    """
    longest_of = {r.size: r.norm for r in longest.collect()}  # one row per vector length

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                ids, asks = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist(), bool)
                vectors = [np.frombuffer(v, np.float64) for v in batch.column(2).to_pylist()]
                for size in {len(v) for v in vectors}:
                    at = np.array([i for i, v in enumerate(vectors) if len(v) == size])
                    same = np.array([vectors[i] for i in at])
                    norm = np.sqrt((same * same).sum(axis=1))
                    data = same / longest_of[size]
                    rest = np.sqrt(np.maximum(0, 1 - (data * data).sum(axis=1)))
                    data = np.column_stack([data, rest]).astype(np.float32)
                    asked = np.flatnonzero(asks[at])
                    query = np.column_stack([same[asked] / norm[asked, None], np.zeros(len(asked))]).astype(np.float32)
                    for tree in range(TREES):
                        own = hash_strings(data, tree)
                        sought = hash_strings(query, tree) if len(asked) else own[:0]
                        itself = np.cumprod(sought == own[asked], axis=1).sum(axis=1)
                        for kind, strings, who, met in ((False, own, at, np.zeros(len(at), int)), (True, sought, at[asked], itself)):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(ids[who]), pa.array([kind] * len(who), pa.bool_()), pa.array([tree] * len(who), pa.int32()),
                                 pa.array([s.tobytes() for s in strings], pa.binary()), pa.array(met, pa.int32())],
                                names=["class", "asks", "tree", "string", "itself"],
                            )

    return classes.select("class", "asks", "packed").mapInArrow(run, "class long, asks boolean, tree int, string binary, itself int")


def _visits(strings: DataFrame, wanted) -> DataFrame:
    """``class, tree, depth, prefix``: the prefixes that each query looks under."""
    deep = F.explode(F.sequence(F.lit(1), F.lit(SYMBOLS))).alias("depth")
    leveled = strings.select("class", "size", "asks", "tree", "itself", deep, "string").withColumn("prefix", F.expr("substring(string, 1, depth)"))
    key = ["size", "tree", "depth", "prefix"]
    counts = leveled.groupBy(*key).agg(F.count_if(~F.col("asks")).alias("n"), F.count_if("asks").alias("q")).where("q > 0 AND n > 0")
    # A query does not find itself.
    others = F.col("n") - (F.col("itself") >= F.col("depth")).cast("long")
    asked = leveled.where("asks").join(counts.select(*key, "n"), key).withColumn("others", others)
    by_level = Window.partitionBy("class", "depth").orderBy("tree").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy("class", "depth")
    summed = (
        asked.withColumn("before", F.coalesce(F.sum("others").over(by_level), F.lit(0)))
        .withColumn("hits", F.sum("others").over(everything))
        .withColumn("wanted", wanted)
    )
    # The deepest level with enough strings; 0, the root, if there is none.
    level = Window.partitionBy("class")
    chosen = summed.withColumn("level", F.coalesce(F.max(F.when(F.col("hits") >= F.col("wanted"), F.col("depth"))).over(level), F.lit(0)))
    at_level = (F.col("depth") == F.col("level")) & (F.col("before") < F.col("wanted"))
    # Trees that are not ascended any more are left one level deeper, as are all above the root.
    reached = F.max(F.when(at_level, F.col("tree"))).over(level)
    deeper = (F.col("depth") == F.col("level") + 1) & (F.col("tree") > reached)
    return chosen.withColumn("at", at_level).withColumn("below", deeper).where("at OR below").select("class", *key, "n", "others")


def nearest(vectors: DataFrame, is_query, vec_id: str = "vec_id", vector: str = "embedding", k: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` nearest among all other rows.

    ``is_query`` is a condition on ``vec_id``. The score is the inner product in double precision; ties
    go to the smaller id. Vectors that are null, all zero, or hold a null or a number that is not finite take no
    part, nor do rows without an id. A row that is there twice counts once. Vectors of different length
    have no inner product and are not compared.
    """
    rows = usable(vectors, vec_id, vector).distinct()
    ordered = Window.partitionBy("vector").orderBy("vec_id")
    firsts = rows.withColumn("_n", F.row_number().over(ordered)).where(F.col("_n") <= k + 1)
    asking = rows.where(is_query).select("vector").distinct().withColumn("asks", F.lit(True))
    classes = (
        firsts.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
        .join(asking, "vector", "left")
        .select(F.monotonically_increasing_id().alias("class"), "vector", "members", F.coalesce("asks", F.lit(False)).alias("asks"), F.size("vector").alias("size"))
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.array(v, np.float64).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(packed, pa.binary())], names=[*batch.schema.names, "packed"])

    schema = "class long, vector array<double>, members array<long>, asks boolean, size int, packed binary"
    classes = stored(classes.mapInArrow(pack, schema), "classes")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    longest = stored(classes.groupBy("size").agg(F.max(norm).alias("norm"), F.count(F.lit(1)).alias("n")), "lengths")
    n_of = {r.size: r.n for r in longest.collect()}
    strings = stored(_strings(classes, longest.select("size", "norm")).join(classes.select("class", "size"), "class"), "strings")
    wanted = F.lit(float("inf"))
    for size, n in n_of.items():
        enough = CANDIDATES * n**GROWTH
        wanted = F.when(F.col("size") == size, F.lit(enough if enough < n else math.inf)).otherwise(wanted)
    visits = stored(_visits(strings, wanted), "visits")
    # Queries for which no level has enough are compared with all; the root is one prefix of one tree.
    to_root = classes.where("asks").join(visits.where(F.col("depth") > 0).groupBy("class").agg(F.sum("others").alias("hits")), "class", "left")
    short = F.coalesce("hits", F.lit(0)) < wanted
    root_n = F.lit(0)
    for size, n in n_of.items():
        root_n = F.when(F.col("size") == size, F.lit(n)).otherwise(root_n)
    root = to_root.where(short).select("class", "size", F.lit(0).alias("tree"), F.lit(0).alias("depth"), F.lit(b"").alias("prefix"), root_n.cast("long").alias("n"))
    visits = stored(visits.drop("others").join(root.select("class"), "class", "left_anti").unionByName(root), "visited")

    key = ["size", "tree", "depth", "prefix"]
    visited = visits.groupBy(*key).agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("q"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    under = strings.where("NOT asks").select("class", "size", "tree", F.explode(F.sequence(F.lit(1), F.lit(SYMBOLS))).alias("depth"), "string")
    under = under.select("class", "size", "tree", "depth", F.expr("substring(string, 1, depth)").alias("prefix"))
    everyone = classes.select("class", "size", F.lit(0).alias("tree"), F.lit(0).alias("depth"), F.lit(b"").alias("prefix"))
    # Both sides are dealt into blocks, and every block of queries meets every block of strings.
    dealt_to = lambda n: F.pmod(F.xxhash64("class"), n).cast("int")
    asking = F.ceil(F.col("q") / BLOCK).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    data = under.unionByName(everyone).join(visited, key).select("class", *key, dealt_to(blocks).alias("block"), every(asking).alias("queries"), F.lit(False).alias("asks"))
    asked = visits.select("class", *key).join(visited, key).select("class", *key, every(blocks).alias("block"), dealt_to(asking).alias("queries"), F.lit(True).alias("asks"))
    dealt = data.unionByName(asked).join(classes.select("class", "packed", F.get("members", F.lit(0)).alias("least")), "class")

    def compare(table: pa.Table) -> pa.Table:
        asks = np.array(table["asks"].to_pylist(), bool)
        ids, least = table["class"].to_numpy(), table["least"].to_numpy()
        out = ([], [], [])
        if asks.any() and not asks.all():
            matrix = _matrix(table["packed"])
            query, other = matrix[asks], matrix[~asks]
            query_ids, other_ids, other_least = ids[asks], ids[~asks], least[~asks]
            longest = np.sqrt((other * other).sum(axis=1)).max()
            for start in range(0, len(query), 256):
                some = query[start : start + 256]
                scores = some @ other.T
                few = min(k + 1, scores.shape[1])
                last = -np.partition(-scores, few - 1, axis=1)[:, few - 1]
                # Rounding of the product must not decide: what is as close as that is compared exactly, and
                # of classes with equal scores those with the smallest ids stay.
                slack = 1e-12 * np.sqrt((some * some).sum(axis=1)) * longest
                row, at = np.nonzero(scores >= (last - slack)[:, None])
                exact = np.einsum("ij,ij->i", some[row], other[at])
                order = np.lexsort((other_least[at], -exact, row))
                row, at, exact = row[order], at[order], exact[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                kept = place < few
                for side, values in zip(out, (query_ids[start : start + 256][row[kept]], other_ids[at[kept]], exact[kept])):
                    side.append(values)
        pick = lambda side, kind: pa.array(np.concatenate([*side, np.empty(0, kind)]).astype(kind))
        return pa.table({"query": pick(out[0], np.int64), "class": pick(out[1], np.int64), "score": pick(out[2], np.float64)})

    found = dealt.groupBy(*key, "block", "queries").applyInArrow(compare, "query long, class long, score double")
    own = classes.where("asks").select(
        F.col("class").alias("query"), "class", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x).alias("score")
    )
    found = found.where("query <> class").unionByName(own).groupBy("query", "class").agg(F.max("score").alias("score"))
    members = found.join(classes.select("class", "members"), "class").select("query", "score", F.explode("members").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = members.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    lists = ranked.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("found"))
    by_vector = classes.where("asks").select("vector", F.col("class").alias("query")).join(lists, "query")
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector").join(by_vector, "vector")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return queries.select("query_id", F.posexplode(others).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")
    )
