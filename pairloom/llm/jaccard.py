"""Exact self-join of documents by the Jaccard similarity of their word shingles.

A document's set holds 64-bit hashes of its distinct shingles. Documents with equal sets are one node.
Nodes are compared by the pigeonhole principle over a partition of the universe of hashes:

* Sizes are cut into bands. Two sets that link, the larger one in band ``b``, differ in at most ``H_b``
  shingles. The universe is cut into ``m_b = H_b + 1`` segments of equal width, so some segment holds the
  same shingles of both. A set is indexed under its content in each segment, in its own band and, if it
  could link with larger sets of the next, in that band as well.
* ``D_b`` of the segments are indexed under their one-deletion neighbourhood as well: they find sets that
  differ there by one shingle, and so count for two. This pays for skipping: a set may leave out what
  costs most, up to ``D_b / 2`` segments, as two sets then miss at most ``D_b``. Costs come from a bounded
  sample: empty segments cost most, then those that hold nothing but shingles frequent in the sample.
  What is over the allowance is indexed all the same, so nothing is lost.

Nodes that share an index entry are candidates. Texts that have no more than a passage in common share
entries by chance, and those entries grow with the table. So in entries of more than ``WIDE`` nodes only those are
candidates that share a rare shingle as well: with shingles in one order, rare ones first, sets that link have one in
common among the first of both, as many as a set may miss and one more. The order comes from a sample, and any order
finds all links. Each such shingle makes an entry of the nodes in wide ones, in their place; entries that
hold the same nodes are one.

Candidates are not paired with each other: each is compared with one centre of its entry, in exact arithmetic on whole sets. That links large groups of near copies in
a star. Entries whose nodes are not all in one component after that are gone through again, in two phases:

* Merging: each node outside of its entry's largest component is compared with one node of another component
  there, the one whose sketch is closest, as long as that joins a good part of what is apart. Each round does
  so in another of a node's entries. A family of copies that do not all link to one of them comes together in
  a few such rounds, with one pair for a node in each.
* Completing: every cross pair of an entry has a node outside of the entry's largest component. Those
  nodes are taken in blocks and compared with all nodes of other components; they are finished then. An
  entry is closed when one component holds it or all nodes outside the largest are finished.

Most pairs need not be compared in full: a set's sketch is the parity of its hashes in
each of 1,024 slots, and sets differ in at least as many shingles as their sketches do in slots. Pairs of
which that is too many, or whose sizes are too far apart, are ruled out before; large sets have longer sketches besides. Whole sets are read from the
texts when their node is first compared. Entries are combined within a task before they are shuffled, so a frequent entry is
one row per task.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T, Window

from pairloom.llm.common import row_hash, ship, stored
from pairloom.llm.components import components
from pairloom.session import setting, shuffles_deleted

ship(__name__)

WIDTH = 4  # words in a shingle
PERCENT = 85  # intersection at least this share of the union
BAND = 1.2  # sizes of a band differ by less than this factor
SEGMENTS_PER_SKIP = 48
BLOCK = 2048  # nodes of an entry whose sketches are compared together
WORTHWHILE = 16  # merging ends when two rounds find links for less than one in so many nodes that are apart
FEW_PAIRS = 100_000  # pairs whose nodes are broadcast, 16 bytes for each
FEW_CROSS = 32  # pairs for each row of the open entries up to which these are completed without merging
CENTRES = 500  # nodes outside an entry's largest component that are completed at a time
SAMPLE_DOCS = 2000  # at least, and one text in so many:
SAMPLE_SHARE = 64
FREQUENT_SHINGLES = 100_000
WIDE = 16  # nodes of an entry, beyond which it is narrowed by rare shingles
ARROW_BYTES = 4 << 20  # texts or sets that a task hands to Python at a time; the JVM and Python both hold them
FLUSH = 600_000  # index entries that a task combines at a time
SKETCH = 16  # 64-bit words of a set's sketch
LONG_SET = 800  # larger sets have a longer sketch besides, in proportion to their size
RARE = np.uint64(1 << 63)  # the bit by which entries of rare shingles are told from those of the index
BITS = 1 << 23  # slots of the bitmap that tells which texts have candidates


SKETCH_WORDS = [f"k{k}" for k in range(SKETCH)]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; a shorter text is one shingle as a whole."""
    words = [words_of(t) for t in texts]
    sizes = [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))
    joined = np.full(len(hashed), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(width):
        part = np.zeros_like(hashed)
        part[: max(0, len(hashed) - k)] = hashed[k:]
        joined = _mix(joined * np.uint64(0xD6E8FEB86659FD93) + part)
    found, start = [], 0
    for size in sizes:
        if size >= width:
            found.append(np.unique(joined[start : start + size - width + 1]))
        elif size:
            whole = np.array([0x632BE59BD9B4E019 + size], np.uint64)
            for k in range(size):
                whole = _mix(whole * np.uint64(0xD6E8FEB86659FD93) + hashed[start + k])
            found.append(whole)
        else:
            found.append(np.empty(0, np.uint64))
        start += size
    return found


def node_of(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


@dataclass(frozen=True)
class Scheme:
    """How sets are compared whose larger one has a size in this band."""

    band: int
    segments: int
    deleted: int  # segments indexed with their one-deletion neighbourhood: the first ones
    allowance: int  # what a set may skip


@dataclass(frozen=True)
class Bands:
    """All schemes for one similarity; sizes beyond the last bound are an error."""

    percent: int
    bounds: tuple[int, ...]

    @classmethod
    def of(cls, percent: int) -> Bands:
        bounds, size = [1], 1
        while size < 1 << 40:
            size = max(size + 1, int(size * BAND))
            bounds.append(size)
        return cls(percent, tuple(bounds))

    def number(self, size: int) -> int:
        return bisect.bisect_right(self.bounds, size) - 1

    def scheme(self, band: int) -> Scheme | None:
        """Nothing for bands in which only equal sets link."""
        most = 2 * (self.bounds[band + 1] - 1) * (100 - self.percent) // (100 + self.percent)
        if most < 1:
            return None
        segments = most + 1
        deleted = min(2 * -(-segments // SEGMENTS_PER_SKIP), segments)
        return Scheme(band, segments, deleted, deleted // 2)

    def schemes(self, size: int) -> list[Scheme]:
        """Of all bands in which the larger set can be."""
        first, last = self.number(size), self.number(size * 100 // self.percent)
        return [s for b in range(first, last + 1) if (s := scheme_of(self, b))]


# Plain dicts: a cached function would be sent by its name, which workers cannot import. There are as many
# entries as bands.
_SCHEMES: dict[tuple[int, int], Scheme | None] = {}
_EDGES: dict[int, np.ndarray] = {}


def scheme_of(bands: Bands, band: int) -> Scheme | None:
    if (bands.percent, band) not in _SCHEMES:
        _SCHEMES[bands.percent, band] = bands.scheme(band)
    return _SCHEMES[bands.percent, band]


def edges_of(segments: int) -> np.ndarray:
    if segments not in _EDGES:
        _EDGES[segments] = np.array([(k << 64) // segments for k in range(segments)], np.uint64)
    return _EDGES[segments]


def index_entries(hashes: np.ndarray, bands: Bands, frequent: np.ndarray) -> np.ndarray:
    """The set's index entries, as 64-bit numbers. Entries that collide only add candidates."""
    schemes = bands.schemes(len(hashes)) if len(hashes) else []
    if not schemes:
        return np.empty(0, np.uint64)
    content = _mix(hashes + np.uint64(0xA0761D6478BD642F))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(content, dtype=np.uint64)])
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        rare = np.concatenate([[0], np.cumsum(frequent[at] != hashes)])
    else:
        rare = np.arange(len(hashes) + 1)
    entries = []
    for scheme in schemes:
        m = scheme.segments
        edge = np.append(np.searchsorted(hashes, edges_of(m)), len(hashes))
        size = np.diff(edge)
        total = sums[edge[1:]] - sums[edge[:-1]]
        key = _mix(np.arange(m, dtype=np.uint64) + np.uint64((scheme.band + 1) << 32))
        # What to skip, most expensive first: nothing in it, then nothing rare in it. A segment with
        # its neighbourhood counts for two; leaving out only the empty one-deletion costs one.
        left = scheme.allowance
        drop = np.zeros(m, bool)
        no_empty = np.zeros(m, bool)
        dull = (rare[edge[1:]] - rare[edge[:-1]]) == 0
        for segment in np.concatenate([np.flatnonzero(size == 0), np.flatnonzero(dull & (size > 0)), np.flatnonzero(size[: scheme.deleted] == 1)]):
            if not left:
                break
            cost = 2 if segment < scheme.deleted else 1
            if size[segment] == 1 and segment < scheme.deleted and not dull[segment]:
                no_empty[segment] = True
                left -= 1
            elif cost <= left:
                drop[segment] = True
                left -= cost
        whole = total + key
        entries.append(_mix(whole)[~drop])
        # The deleted segments are the first ones, and so are their shingles.
        segment = np.repeat(np.arange(scheme.deleted), size[: scheme.deleted])
        without = whole[segment] - content[: len(segment)]
        entries.append(_mix(without[~(drop | no_empty)[segment]]))
    return np.concatenate(entries)


def rare_shingles(hashes: np.ndarray, percent: int, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of the set, by their count in the sample and then by hash: as many as a set that links
    may miss, and one more. Two sets that link have one of them in common."""
    length = len(hashes) - -(-percent * len(hashes) // 100) + 1
    if not len(known):
        return hashes[:length]
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    often = known[at] == hashes
    unseen = hashes[~often]
    if len(unseen) >= length:
        return unseen[:length]
    rest = np.flatnonzero(often)
    order = np.argsort(counts[at[rest]], kind="stable")  # hashes are in order already
    return np.concatenate([unseen, hashes[rest[order[: length - len(unseen)]]]])


def sketch_of(hashes: np.ndarray) -> np.ndarray:
    """Parity of the number of hashes in each slot, as 64-bit words."""
    slot = (_mix(hashes + np.uint64(0xE7037ED1A0B428DB)) % np.uint64(64 * SKETCH)).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=64 * SKETCH) & 1).astype(np.uint8)).view(np.int64)


def long_sketch(hashes: np.ndarray) -> bytes:
    """The parity of the hashes in each of a power of two slots, more than there are hashes; empty for a set
    whose short sketch tells enough."""
    if len(hashes) <= LONG_SET:
        return b""
    slots = 1 << len(hashes).bit_length()
    slot = (_mix(hashes + np.uint64(0x8EBC6AF09C88C6E3)) & np.uint64(slots - 1)).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=slots) & 1).astype(np.uint8)).tobytes()


def sketches_apart(x: np.ndarray, y: np.ndarray) -> int:
    """In how many slots two long sketches differ; the longer one is folded to the other's length, as slots that
    fall together add their parities."""
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def may_link(percent: int, x: str, y: str):
    """Whether two nodes' sizes and sketches allow a link; columns have the given prefixes."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    apart = None
    for k in range(SKETCH):
        bits = F.bit_count(F.col(f"{x}k{k}").bitwiseXOR(F.col(f"{y}k{k}")))
        apart = bits if apart is None else apart + bits
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return sizes & (apart * (100 + percent) <= (n + m) * (100 - percent))


def describe(docs: DataFrame, doc_id: str, text: str, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, node`` and the sketch: the node is the set's digest, null for an empty one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                sets = shingle_sets(batch.column(1).to_pylist(), width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([node_of(s) if len(s) else None for s in sets], pa.binary()),
                     *map(pa.array, np.array([sketch_of(s) for s in sets]).T)],
                    names=["doc_id", "n_shingles", "node", *SKETCH_WORDS],
                )

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_shingles", T.LongType()), T.StructField("node", T.BinaryType()), *[T.StructField(k, T.LongType()) for k in SKETCH_WORDS]])
    return docs.select(F.col(doc_id).alias("doc_id"), text).mapInArrow(run, schema)


def frequent_shingles(docs: DataFrame, text: str, n_nodes: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted shingles in more than one text of a sample, their counts there, and those in at least one text in a
    hundred. They only steer what is skipped and what counts as rare."""
    size = max(SAMPLE_DOCS, n_nodes // SAMPLE_SHARE)
    slots = 1 << 30
    drawn = docs.select(text).where(F.pmod(row_hash(text), F.lit(slots)) < min(slots, slots * size // max(1, n_nodes))).distinct()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                sets = shingle_sets(whole.column(0).slice(start, 256).to_pylist(), width)
                values, counts = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts, pa.int64())], names=["h", "n"])

    counted = drawn.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    often = counted.where("n > 1").orderBy(F.desc("n"), "h").limit(FREQUENT_SHINGLES).toArrow()
    known, counts = often.column("h").to_numpy().view(np.uint64), often.column("n").to_numpy()
    order = np.argsort(known)
    known, counts = known[order], counts[order]
    return known, counts, known[counts >= size // 100]


def entries_shared(docs: DataFrame, text: str, percent: int, n_nodes: int, width: int = WIDTH) -> DataFrame:
    """``entry, node, centre`` of all nodes that share an index entry or a rare shingle with a smaller one. Numbers of
    rare shingles are negative, those of index entries are not.

    Nodes are told by the first eight bytes of their digest. Within a task and again after the shuffle,
    the nodes of an entry are linked to the smallest of them, and only that one goes on.
    """
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(frequent_shingles(docs, text, n_nodes, width))
    bands = Bands.of(percent)
    pair = np.dtype([("entry", "<u8"), ("node", "<i8")])

    def combine(entry: np.ndarray, node: np.ndarray):
        """Distinct pairs in order: those that are not first in their entry with its first, and those that are."""
        order = np.lexsort((node, entry))
        entry, node = entry[order], node[order]
        new = np.ones(len(entry), bool)
        new[1:] = (entry[1:] != entry[:-1]) | (node[1:] != node[:-1])
        entry, node = entry[new], node[new]
        first = np.ones(len(entry), bool)
        first[1:] = entry[1:] != entry[:-1]
        centre = node[first][np.cumsum(first) - 1]
        return (entry[~first], node[~first], centre[~first]), (entry[first], node[first])

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, nodes, held = [], [], 0
        known, counts, frequent = shared.value

        def flush():
            inner, going = combine(np.concatenate(entries), np.concatenate(nodes))
            target = (going[0] % np.uint64(parts)).astype(np.int32)
            order = np.argsort(target, kind="stable")
            packed = np.empty(len(order), pair)
            packed["entry"], packed["node"] = going[0][order], going[1][order]
            cuts = np.searchsorted(target[order], np.arange(parts + 1))
            full = np.flatnonzero(np.diff(cuts))
            blobs = [packed[cuts[p] : cuts[p + 1]].tobytes() for p in full]
            # Pairs found here travel to tasks by their place, not by their entry.
            spread, size = [], 4096
            for k in range(0, len(inner[0]), size):
                spread.append(np.stack([x[k : k + size].view(np.int64) for x in inner]).tobytes())
            there = [(int(full[k % len(full)]) if len(full) else k % parts) for k in range(len(spread))]
            return pa.RecordBatch.from_arrays(
                [pa.array([*map(int, full), *there], pa.int32()), pa.array([False] * len(blobs) + [True] * len(spread)), pa.array([*blobs, *spread], pa.binary())],
                names=["part", "paired", "data"],
            )

        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                for s in shingle_sets(whole.column(0).slice(start, 64).to_pylist(), width):
                    found = index_entries(s, bands, frequent)
                    if len(found):
                        found = np.concatenate([found & ~RARE, rare_shingles(s, percent, known, counts) | RARE])
                        entries.append(found)
                        nodes.append(np.full(len(found), int.from_bytes(node_of(s)[:8], "little", signed=True)))
                        held += len(found)
                if held > FLUSH:
                    yield flush()
                    entries, nodes, held = [], [], 0
        if held:
            yield flush()

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(entry, node, centre):
            return pa.RecordBatch.from_arrays([pa.array(entry.view(np.int64)), pa.array(node), pa.array(centre)], names=["entry", "node", "centre"])

        blobs = {}
        for batch in batches:
            for part, paired, data in zip(*(c.to_pylist() for c in batch.columns)):
                if paired:
                    yield out(*np.frombuffer(data, np.int64).reshape(3, -1))
                else:
                    blobs.setdefault(part, []).append(data)
        # No entry is in two parts, so they are combined one after the other, in a part of the memory.
        while blobs:
            rows = np.frombuffer(b"".join(blobs.popitem()[1]), pair)
            inner, _ = combine(rows["entry"], rows["node"])
            for k in range(0, len(inner[0]), 65536):
                yield out(*(x[k : k + 65536] for x in inner))

    made = docs.select(text).mapInArrow(make, "part int, paired boolean, data binary")
    return made.repartition(parts // 4, "part").mapInArrow(meet, "entry long, node long, centre long")


def sets_of(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame, width: int = WIDTH) -> DataFrame:
    """``node, hashes, size, sketch`` for the ``wanted`` nodes (with the id of one of their documents).

    The texts of other documents are passed over by a bitmap of fixed size before they are read; what
    it lets through by chance is left out by the join.
    """
    spark = docs.sparkSession
    slot = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(BITS))
    marked = wanted.select(F.pmod(F.xxhash64("doc_id"), F.lit(BITS)).alias("s"))
    rows = marked.groupBy(F.bitmap_bucket_number("s").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m")).collect()
    bitmap = bytearray(BITS // 8 + 8192)  # one row per 4 KB of it
    for row in rows:
        bitmap[(row.b - 1) * 4096 : row.b * 4096] = row.m
    shared = spark.sparkContext.broadcast(bytes(bitmap))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for whole in batches:
            # Bucket numbers of Spark's bitmaps start at 1 for slots 1 to 32768; slot 0 is bucket 0.
            at = whole.column(0).to_numpy() - 1
            known = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            chosen = np.flatnonzero(known | (at < 0))
            for start in range(0, len(chosen), 256):
                texts = whole.column(1).take(pa.array(chosen[start : start + 256])).to_pylist()
                sets = [s for s in shingle_sets(texts, width) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int.from_bytes(node_of(s)[:8], "little", signed=True) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array([long_sketch(s) for s in sets], pa.binary())],
                    names=["node", "hashes", "size", "sketch"],
                )

    found = docs.select(slot.alias("_slot"), text).mapInArrow(run, "node long, hashes binary, size long, sketch binary")
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def links_among(pairs: DataFrame, sets: DataFrame, percent: int, n_pairs: int | None = None) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar enough, compared exactly.

    Large sets, of which short sketches say little, are compared by their long sketches first. Up to ``FEW_PAIRS`` pairs are broadcast first, by their number, so that no other sets are shuffled.
    """
    if n_pairs is not None and n_pairs <= FEW_PAIRS:
        sets = sets.join(F.broadcast(_both(pairs).withColumnRenamed("short", "node")), "node", "left_semi")

    def rule_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                fits = min(n, m) * 100 >= max(n, m) * percent
                if fits and x and y:
                    fits = sketches_apart(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) * (100 + percent) <= (n + m) * (100 - percent)
                keep.append(fits)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    light = lambda key, n, sketch: sets.select(F.col("node").alias(key), F.col("size").alias(n), F.col("sketch").alias(sketch))
    sketched = pairs.join(light("a", "n", "x"), "a").join(light("b", "m", "y"), "b").select("a", "b", "n", "m", "x", "y")
    pairs = sketched.mapInArrow(rule_out, "a long, b long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    first = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document, by shingles of ``width`` words.

    Two documents link when 100 times their intersection is at least ``percent`` times their union;
    the component's id is the smallest document id that links lead to, the own included. A null or
    empty text, or one of white space, has an empty set and links with nothing. Repeated rows and
    repeated ids link like any other documents; a null id never is the smallest, and a document with
    a null id that links with nothing has a null component. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES)), shuffles_deleted(spark):
        return _components_of(docs, doc_id, text, percent, width)


def _components_of(docs: DataFrame, doc_id: str, text: str, percent: int, width: int) -> DataFrame:
    """``near_copies``: all that runs in Python is stored before it returns."""
    described = stored(describe(docs, doc_id, text, width), "described")
    nodes = (
        described.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n"), *[F.min(k).alias(k) for k in SKETCH_WORDS])
        .withColumn("short", _first_eight(F.col("node")))
    )
    nodes = stored(nodes, "nodes")
    if nodes.groupBy("short").count().where("count > 1").head():
        raise RuntimeError("two different sets have digests with the same first eight bytes")
    known = nodes.select("short", "n", *SKETCH_WORDS)
    entries = _narrowed(stored(entries_shared(docs, text, percent, nodes.count(), width), "entries"))
    pairs = entries.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    pairs = stored(_possible(pairs, known, percent), "pairs")
    sets = _sets_for(docs, doc_id, text, nodes, _both(pairs), width)
    links = stored(links_among(pairs, sets, percent), "verified")
    found = stored(components(links), "components")

    active = entries.select("entry", "node").withColumn("finished", F.lit(False))
    done, merging, poor, turn = pairs, True, 0, 0
    while True:
        active, apart = _still_open(active, found)
        if not apart:
            break
        if merging and poor == 0 and _cross_pairs(active) <= FEW_CROSS * active.count():
            merging = False
        if merging:
            new = _merging_pairs(active, known, percent, turn).join(done, ["a", "b"], "left_anti")
        else:
            new, active = _completing_pairs(active, known, percent)
            new = new.join(done, ["a", "b"], "left_anti")
        new = stored(new, "pairs")
        n_pairs, n_links = new.count(), 0
        if n_pairs:
            # Sets are read from the texts once, when their node is first compared.
            missing = stored(_both(new).join(sets.select(F.col("node").alias("short")), "short", "left_anti"), "missing")
            if missing.head():
                sets = sets.unionByName(_sets_for(docs, doc_id, text, nodes, missing, width))
            more = stored(links_among(new, sets, percent, n_pairs), "verified")
            done, n_links = done.unionByName(new), more.count()
        if n_links:
            found = _regrouped(found, more)
        poor = poor + 1 if n_links * WORTHWHILE < apart else 0
        merging, turn = merging and poor < 2, turn + 1
    grouped = nodes.join(found.withColumnRenamed("node", "short"), "short", "left").select(
        "node", "doc_id", F.coalesce("component", "short").alias("component")
    )
    least = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    ids = grouped.join(least, "component").select("node", "component_id")
    return described.join(ids, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _narrowed(entries: DataFrame) -> DataFrame:
    """``entry, node, centre`` of all nodes of the entries to be compared, with the entry's smallest node.

    Wide index entries give way to the rare shingles of their nodes. Of entries with the same nodes one is kept.
    """
    rows = entries.select("entry", "node").union(entries.select("entry", F.col("centre").alias("node"))).distinct()
    rows = stored(rows, "members")
    index, rare = rows.where("entry >= 0"), rows.where("entry < 0")
    held = lambda members: members.groupBy("entry").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("centre"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")
    )
    told = stored(held(index), "index-entries")
    crowd = stored(index.join(told.where(F.col("n") > WIDE).select("entry"), "entry", "left_semi").select("node").distinct(), "crowd")
    rare = stored(rare.join(crowd, "node", "left_semi"), "rare-members")
    every = told.where(F.col("n") <= WIDE).unionByName(held(rare)).where("n > 1")
    chosen = every.groupBy("n", "centre", "x", "y").agg(F.min("entry").alias("entry")).select("entry", "centre")
    return stored(index.unionByName(rare.select(*index.columns)).join(chosen, "entry"), "active")


def _both(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("short")).union(pairs.select(F.col("b").alias("short"))).distinct()


def _possible(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and sketches do not rule out."""
    called = lambda prefix: known.select(*[F.col(c).alias(prefix + c) for c in known.columns])
    return pairs.join(called("x_"), F.col("a") == F.col("x_short")).join(
        called("y_"), (F.col("b") == F.col("y_short")) & may_link(percent, "x_", "y_")
    ).select("a", "b")


def _still_open(active: DataFrame, found: DataFrame) -> tuple[DataFrame, int]:
    """Rows of the entries that are not closed, with ``component`` and the entry's largest as ``main``, and
    how many nodes there are outside of it and not finished."""
    of = active.select("entry", "node", "finished").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    groups = of.groupBy("entry", "component").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("finished")).alias("open"))
    main = groups.groupBy("entry").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("open").alias("open"), F.max_by("open", F.struct("n", "component")).alias("inside"), F.count(F.lit(1)).alias("parts")
    )
    main = main.where((F.col("parts") > 1) & (F.col("open") > F.col("inside"))).select("entry", "main")
    still = stored(of.join(main, "entry"), "open-entries")
    return still, still.where("component <> main AND NOT finished").select("node").distinct().count()


def _cross_pairs(active: DataFrame) -> int:
    """How many pairs completing all of these entries can compare at the most."""
    outside = F.count_if((F.col("component") != F.col("main")) & ~F.col("finished"))
    per_entry = active.groupBy("entry").agg((outside * F.count(F.lit(1))).alias("pairs"))
    return per_entry.agg(F.coalesce(F.sum("pairs"), F.lit(0))).head()[0]


def _merging_pairs(active: DataFrame, known: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each open node outside its entry's largest component, in one of its entries, with the node of another
    component there whose sketch is closest, if sizes and sketches allow a link.

    Nodes that share entries choose the same one. Askers and members of an entry are dealt into blocks, and
    an asker gets an answer from each block of members.
    """
    one = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64(F.lit(turn), "entry"), "entry"))
    asking = active.where("component <> main AND NOT finished").withColumn("r", one).where("r = 1").select("entry", "node", "component")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    asked = asking.groupBy("entry").agg(F.count(F.lit(1)).alias("q"))
    sizes = active.groupBy("entry").agg(F.count(F.lit(1)).alias("n")).join(asked, "entry")
    sizes = stored(sizes.select("entry", blocks("q").alias("askers"), blocks("n").alias("members")), "asked-entries")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = asking.join(sizes, "entry").select("entry", "node", "component", F.lit(True).alias("asks"), own("askers").alias("i"), every("members").alias("j"))
    held = active.join(sizes, "entry").select("entry", "node", "component", F.lit(False).alias("asks"), every("askers").alias("i"), own("members").alias("j"))
    rows = dealt.unionByName(held).join(known.withColumnRenamed("short", "node"), "node")

    def closest(table: pa.Table) -> pa.Table:
        node, component, size = (table.column(c).to_numpy() for c in ("node", "component", "n"))
        asks = table.column("asks").to_numpy()
        sketch = np.stack([table.column(k).to_numpy() for k in SKETCH_WORDS], axis=1).view(np.uint64)
        members, askers = np.flatnonzero(~asks), np.flatnonzero(asks)
        first, second = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for start in range(0, len(askers) if len(members) else 0, 32):
            some = askers[start : start + 32]
            n, m = size[some][:, None], size[members][None, :]
            may = (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent) & (component[some][:, None] != component[members][None, :])
            row, at = np.nonzero(may)
            most = (size[some[row]] + size[members[at]]) * (100 - percent)
            apart = np.zeros(len(row), np.int64)
            # A few words at a time: most pairs are too far apart after the first.
            for k in range(0, SKETCH, 4):
                x, y = sketch[some[row], k : k + 4], sketch[members[at], k : k + 4]
                apart += np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
                left = apart * (100 + percent) <= most
                row, at, most, apart = row[left], at[left], most[left], apart[left]
            order = np.lexsort((node[members[at]], apart, row))
            best = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
            first.append(node[some[row[best]]])
            second.append(node[members[at[best]]])
        x, y = np.concatenate(first), np.concatenate(second)
        return pa.table({"a": pa.array(np.maximum(x, y)), "b": pa.array(np.minimum(x, y))})

    return rows.groupBy("entry", "i", "j").applyInArrow(closest, "a long, b long").distinct()


def _completing_pairs(active: DataFrame, known: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """A block of each entry's open nodes outside its largest component with all nodes of other components,
    and the rows with those nodes finished."""
    place = F.row_number().over(Window.partitionBy("entry").orderBy("node"))
    chosen = active.where("component <> main AND NOT finished").withColumn("r", place).where(F.col("r") <= CENTRES)
    chosen = stored(chosen.select("entry", "node", F.col("component").alias("its")), "centres")
    called = lambda prefix: known.select(*[F.col(c).alias(prefix + c) for c in known.columns])
    centres = chosen.join(called("y_"), F.col("node") == F.col("y_short")).withColumnRenamed("entry", "at").drop("node")
    near = active.join(called("x_"), F.col("node") == F.col("x_short")).join(
        centres, (F.col("entry") == F.col("at")) & (F.col("component") != F.col("its")) & may_link(percent, "x_", "y_")
    )
    near = near.select(F.greatest("x_short", "y_short").alias("a"), F.least("x_short", "y_short").alias("b")).distinct()
    marked = active.join(chosen.select("entry", "node", F.lit(True).alias("now")), ["entry", "node"], "left")
    return near, marked.select("entry", "node", (F.col("finished") | F.col("now").isNotNull()).alias("finished"))


def _regrouped(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links, which join components and nodes that had none."""
    alone = _both(links).withColumnRenamed("short", "node").join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    every = stored(found.unionByName(alone), "components")
    of = lambda side: every.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
    joined = components(links.join(of("a"), "a").join(of("b"), "b").select("of_a", "of_b").distinct(), "of_a", "of_b")
    joined = stored(joined, "joined").select(F.col("node").alias("component"), F.col("component").alias("_now"))
    return stored(every.join(joined, "component", "left").select("node", F.coalesce("_now", "component").alias("component")), "components")


def _sets_for(docs: DataFrame, doc_id: str, text: str, nodes: DataFrame, touched: DataFrame, width: int) -> DataFrame:
    """The stored sets of the nodes that are compared."""
    wanted = stored(nodes.join(touched, "short").select(F.col("short").alias("node"), "doc_id"), "wanted")
    return stored(sets_of(docs, doc_id, text, wanted, width), "sets")


def _first_eight(node):
    """The first eight bytes as a signed little-endian number, as tasks read them."""
    value = F.lit(0).cast("long")
    for k in range(8):
        byte = F.conv(F.hex(F.substring(node, k + 1, 1)), 16, 10).cast("long")
        value = value.bitwiseOR(F.shiftleft(byte, 8 * k))
    return value
