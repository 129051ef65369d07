"""Repeated lines, by sharded minimal perfect hashes that documents probe instead of joining lines.

A line's key is the line without white space at its ends, A-Z lower-cased; its 128-bit hash stands for
it. Each shard of the hashes is numbered without gaps by a minimal perfect hash: levels of bits, where
a hash is settled on the first level on which nothing else falls on its place, and its number is that of
set bits before it. The numbers address arrays of fingerprints (the half of the hash that levels do not
settle, so that a line that is not in the index is taken for one with odds of 2^-64) and document counts,
and of owners (the smallest id) for those in several documents.

Only hashes travel, packed by shard: first one for each stretch of documents, to build the shards, then
one for each line, to probe them. Lines so frequent that they would crowd a shard are kept out of the
second: there are fewer than ``HOT_KEYS`` of them by count, so they make one shard that every task gets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.common import fresh, ship, stored

ship(__name__)

LEAST_CHARS = 10
LEAST_DOCUMENTS = 2
# Bytes of text whose lines make a shard, entries that a task gathers before it sends them, and the
# bound on lines that are kept apart. A line in fewer documents than HOT_FLOOR is never apart.
SHARD_BYTES = 8 << 20
FLUSH = 400_000
HOT_KEYS = 1 << 20
HOT_FLOOR = 1024
# A null id counts as the largest.
NO_ID = np.iinfo(np.int64).max

PACKETS = "shard long, hashes binary, owners binary, counts binary"
SHARDS = "shard long, n long, sizes binary, bits binary, fingerprints binary, counts binary, owners binary"
PROBES = "shard long, hashes binary, lines binary, ids binary, rows binary, k1 binary, k2 binary"
REPLIES = "k1 long, k2 long, shard long, lines binary"


@dataclass(frozen=True)
class LineIndex:
    """``shards`` has a row per shard; ``hot`` is a shard of its own, as plain arrays."""

    shards: DataFrame
    n_shards: int
    hot: dict
    least_chars: int


def line_keys(text: bytes | None, least_chars: int) -> list[tuple[int, bytes]]:
    """Number and key of the lines whose key is long enough."""
    found = []
    for n, line in enumerate((text or b"").lower().split(b"\n")):
        key = line.strip()
        if len(key) >= least_chars and (len(key) >= 4 * least_chars or len(key.decode("utf-8", "replace")) >= least_chars):
            found.append((n, key))
    return found


def hashes_of(keys: list[bytes]) -> np.ndarray:
    """128-bit hashes as rows of two unsigned numbers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), np.uint64).reshape(-1, 2)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (_mixed(hashes[:, 1] ^ _mixed(hashes[:, 0] + salt)) % np.uint64(size)).astype(np.int64)


def build_shard(hashes: np.ndarray, counts: np.ndarray, owners: np.ndarray) -> dict:
    """The arrays of a shard of distinct hashes."""
    levels, rest = [], np.arange(len(hashes))
    while len(rest):
        size = max(16, 2 * len(rest))
        at = _place(hashes[rest], len(levels), size)
        levels.append(np.bincount(at, minlength=size) == 1)
        rest = rest[~levels[-1][at]]
    shard = {
        "sizes": np.array([len(x) for x in levels], np.int64),
        "bits": np.concatenate(levels) if levels else np.zeros(0, bool),
    }
    order = np.empty(len(hashes), np.int64)
    order[_number(shard, hashes)] = np.arange(len(hashes))
    several = counts[order] >= 2
    return shard | {
        "fingerprints": hashes[order, 0],
        "counts": np.minimum(counts[order], 2**32 - 1).astype(np.uint32),
        "owners": owners[order][several],
    }


def _number(shard: dict, hashes: np.ndarray) -> np.ndarray:
    """Each hash's number, -1 for one that falls on no set bit."""
    number, rest, start = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
    before = np.cumsum(shard["bits"], dtype=np.int64) - 1
    for level, size in enumerate(shard["sizes"].tolist()):
        at = start + _place(hashes[rest], level, size)
        hit = shard["bits"][at]
        number[rest[hit]] = before[at[hit]]
        rest, start = rest[~hit], start + size
    return number


def probe_shard(shard: dict, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In how many documents each line stands (0 if it is not known), and its owner where several have it."""
    counts, owners = np.zeros(len(hashes), np.int64), np.full(len(hashes), -1, np.int64)
    if not len(shard["counts"]) or not len(hashes):
        return counts, owners
    number = _number(shard, hashes)
    slot = np.maximum(number, 0)
    known = (number >= 0) & (shard["fingerprints"][slot] == hashes[:, 0])
    counts[known] = shard["counts"][slot[known]]
    several = counts >= 2
    owners[several] = shard["owners"][(np.cumsum(shard["counts"] >= 2) - 1)[slot[several]]]
    return counts, owners


def _shard_of(hashes: np.ndarray, n_shards: int) -> np.ndarray:
    return ((hashes[:, 1] >> np.uint64(20)) % np.uint64(n_shards)).astype(np.int64)


def _distinct(hashes: np.ndarray, counts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry for each hash, with the sum of counts and the smallest owner."""
    order = np.lexsort((owners, hashes[:, 0], hashes[:, 1]))
    hashes, counts, owners = hashes[order], counts[order], owners[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]).any(axis=1)
    starts = np.flatnonzero(first)
    return hashes[starts], np.add.reduceat(counts, starts) if len(starts) else counts, owners[starts]


def _cuts(shards: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Number and stretch of each shard in sorted shard numbers."""
    starts = np.flatnonzero(np.diff(shards, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(shards)]):
        yield int(shards[a]), slice(a, b)


def _joined(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _unpacked(row: dict) -> dict:
    shard = {"sizes": np.frombuffer(row["sizes"], np.int64)}
    shard["bits"] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(shard["sizes"].sum())).astype(bool)
    for name, dtype in (("fingerprints", np.uint64), ("counts", np.uint32), ("owners", np.int64)):
        shard[name] = np.frombuffer(row[name], dtype)
    return shard


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _ids(column: pa.Array) -> list[int]:
    return column.cast(pa.int64()).fill_null(NO_ID).to_pylist()


def index_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", least_chars: int = LEAST_CHARS) -> LineIndex:
    """The index of all lines of the documents; ``id_col`` is integer, a null id counts as the largest."""
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).head()[0]
    n_shards = max(1, -(-n_bytes // SHARD_BYTES))
    # A key takes least_chars bytes and its line break, so this bounds how many there are.
    hot_from = max(HOT_FLOOR, n_bytes // (least_chars + 1) // HOT_KEYS)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners = [], []

        def flushed() -> pa.RecordBatch:
            hashes, counts, least = _distinct(hashes_of(keys), np.ones(len(keys), np.int64), np.array(owners, np.int64))
            shards = _shard_of(hashes, n_shards)
            order = np.argsort(shards, kind="stable")
            hashes, counts, least = hashes[order], counts[order], least[order]
            rows = [(s, hashes[c].tobytes(), least[c].tobytes(), counts[c].tobytes()) for s, c in _cuts(shards[order])]
            keys.clear(), owners.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["shard", "hashes", "owners", "counts"])

        for batch in batches:
            for text, owner in zip(_texts(batch.column(0)), _ids(batch.column(1))):
                own = {key for _, key in line_keys(text, least_chars)}
                keys.extend(own)
                owners.extend([owner] * len(own))
                if len(keys) >= FLUSH:
                    yield flushed()
        if keys:
            yield flushed()

    def build(key: tuple, packets: pa.Table) -> pa.Table:
        hashes = _joined(packets.column("hashes"), np.uint64).reshape(-1, 2)
        hashes, counts, owners = _distinct(hashes, _joined(packets.column("counts"), np.int64), _joined(packets.column("owners"), np.int64))
        hot = counts >= hot_from
        rows = []
        # What is hot is sent to the driver, under a number that no shard has.
        for number, kept in ((key[0].as_py(), ~hot), (-1, hot)):
            if kept.any():
                x = build_shard(hashes[kept], counts[kept], owners[kept])
                extra = hashes[kept].tobytes() if number < 0 else np.packbits(x["bits"]).tobytes()
                held = (counts[kept], owners[kept]) if number < 0 else (x["counts"], x["owners"])
                rows.append((number, int(kept.sum()), x["sizes"].tobytes(), extra, x["fingerprints"].tobytes(), held[0].tobytes(), held[1].tobytes()))
        return pa.table([pa.array(x) for x in zip(*rows)], ["shard", "n", "sizes", "bits", "fingerprints", "counts", "owners"])

    plain = docs.select(F.col(text_col).cast("string"), F.col(id_col).cast("long"))
    packets = plain.mapInArrow(gather, PACKETS)
    shards = stored(packets.groupBy("shard").applyInArrow(build, SHARDS), "lines")
    apart = shards.where("shard < 0").select("bits", "counts", "owners").collect()
    hashes, counts, owners = (np.frombuffer(b"".join(bytes(r[k]) for r in apart), t) for k, t in enumerate((np.uint64, np.int64, np.int64)))
    return LineIndex(shards.where("shard >= 0"), n_shards, build_shard(hashes.reshape(-1, 2), counts, owners), least_chars)


def drop_repeated(
    docs: DataFrame, index: LineIndex, text_col: str = "text", id_col: str = "doc_id", least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """All rows and columns, then ``n_lines`` (before), ``n_dropped`` and ``kept_text``.

    A line in at least ``least_documents`` (2 or more) documents of the index stays in the one with the
    smallest id only, there as often as it stands. Rows that share an id are one document in this, though
    each counts. A null or empty text has one empty line; an empty table gives no rows. The new columns get
    other names if the table has these. Very long texts are handled whole, one row at a time.
    """
    n_shards, least = index.n_shards, index.least_chars
    hot = docs.sparkSession.sparkContext.broadcast(index.hot)
    k1, k2, replied, n_lines, n_dropped, kept = fresh(docs, "_k1", "_k2", "_replied", "n_lines", "n_dropped", "kept_text")
    # Two rows of equal id and text have the same answer, so their hash is all that has to come back.
    keyed = docs.withColumns({k1: F.xxhash64(id_col, text_col), k2: F.xxhash64(F.lit(17), text_col, id_col)})

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "hashes", "lines", "ids", "rows", "k1", "k2"]
        keys, lines, rows, ids, ones, twos = [], [], [], [], [], []

        def flushed() -> Iterator[pa.RecordBatch]:
            hashes, row, line = hashes_of(keys), np.array(rows, np.int32), np.array(lines, np.int32)
            cold = np.flatnonzero(probe_shard(hot.value, hashes)[0] == 0)
            shards = _shard_of(hashes[cold], n_shards)
            order = np.argsort(shards, kind="stable")
            cold, shards = cold[order], shards[order]
            out = []
            for s, c in _cuts(shards):
                at = cold[c]
                held, local = np.unique(row[at], return_inverse=True)
                told = [np.array(x, np.int64)[held].tobytes() for x in (ids, ones, twos)]
                out.append((s, hashes[at].tobytes(), line[at].tobytes(), told[0], local.astype(np.int32).tobytes(), *told[1:]))
            for x in (keys, lines, rows, ids, ones, twos):
                x.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names)

        for batch in batches:
            for text, own, one, two in zip(_texts(batch.column(0)), _ids(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                found = line_keys(text, least)
                if not found:
                    continue
                lines.extend(n for n, _ in found)
                keys.extend(key for _, key in found)
                rows.extend([len(ids)] * len(found))
                ids.append(own), ones.append(one), twos.append(two)
                if len(keys) >= FLUSH:
                    yield from flushed()
        if keys:
            yield from flushed()

    def answer(probes: pa.Table, shards: pa.Table) -> pa.Table:
        out = []
        shard = _unpacked(shards.to_pylist()[0]) if shards.num_rows else None
        for p in probes.to_pylist() if shard else ():
            row, line = np.frombuffer(p["rows"], np.int32), np.frombuffer(p["lines"], np.int32)
            ids, one, two = (np.frombuffer(p[k], np.int64) for k in ("ids", "k1", "k2"))
            counts, owners = probe_shard(shard, np.frombuffer(p["hashes"], np.uint64).reshape(-1, 2))
            gone = np.flatnonzero((counts >= least_documents) & (owners != ids[row]))
            for r, c in _cuts(row[gone]):
                out.append((int(one[r]), int(two[r]), p["shard"], line[gone[c]].tobytes()))
        columns = zip(*out) if out else [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.table([pa.array(list(x), t) for x, t in zip(columns, kinds)], ["k1", "k2", "shard", "lines"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index
            texts, ids, answers = _texts(batch.column(at(text_col))), _ids(batch.column(at(id_col))), batch.column(at(replied)).to_pylist()
            found = [line_keys(text, least) for text in texts]
            counts, owners = probe_shard(hot.value, hashes_of([key for f in found for _, key in f]))
            common = (counts >= least_documents).tolist()
            total, dropped, rest, n = [], [], [], 0
            for text, own, told, mine in zip(texts, ids, answers, found):
                lines = (text or b"").split(b"\n")
                gone = {k for x in told or () for k in np.frombuffer(x, np.int32).tolist()}
                for k, _ in mine:
                    if common[n] and owners[n] != own:
                        gone.add(k)
                    n += 1
                total.append(len(lines))
                dropped.append(len(gone))
                rest.append(b"\n".join([x for k, x in enumerate(lines) if k not in gone]) if gone else text or b"")
            columns = [c for c, name in zip(batch.columns, batch.schema.names) if name != replied]
            names = [name for name in batch.schema.names if name != replied]
            new = [pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(rest, pa.binary()).view(pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *new], [*names, n_lines, n_dropped, kept])

    plain = keyed.select(F.col(text_col).cast("string"), F.col(id_col).cast("long"), k1, k2)
    probes = plain.mapInArrow(ask, PROBES)
    replies = probes.groupBy("shard").cogroup(index.shards.groupBy("shard")).applyInArrow(answer, REPLIES)
    # Copies of a row ask the same, so one answer of each shard is kept before answers are put together.
    replies = replies.groupBy("k1", "k2", "shard").agg(F.first("lines").alias("lines")).groupBy("k1", "k2").agg(F.collect_list("lines").alias(replied))
    told = keyed.join(replies.withColumnsRenamed({"k1": k1, "k2": k2}).hint("shuffle_hash"), [k1, k2], "left").drop(k1, k2)
    number = F.lit(0).cast("long")
    return told.mapInArrow(cut, docs.select("*", number.alias(n_lines), number.alias(n_dropped), F.lit("").alias(kept)).schema)


#: DuckDB: the same rows, from the contract.
ORACLE_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
    FROM documents),
keyed AS (
    SELECT doc_id, n, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
owned AS (
    SELECT key, min(doc_id) AS own FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
    SELECT k.doc_id, n, line, own IS NOT NULL AND own <> k.doc_id AS gone
    FROM keyed k LEFT JOIN owned USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
