"""Phrase collocations, counted level by level in tiles of frequency-ranked ids.

Texts are packed into units of one language, about 16 MB of text each: a list of words and the sequence of
their places in it. Everything later reads units. On each level the frequent phrases of k words have ids by
rank of frequency, and a unit holds the places where one begins with its id. Two neighbours that both are
frequent make a phrase of k + 1 words, a cell of the table of id pairs. In a unit, tiles of the table in which
many cells are met are counted by ``bincount`` at the cell's own address, all others as sorted coordinates.
Counts then meet by tile, packed, where frequent pairs get new ids by rank and every unit is told those of its
own pairs: they are the ids of the next level. No dictionary is ever sent to all tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.llm.common import ship, stored

ship(__name__)

LEAST_COUNT = 100
LONGEST = 5
TOP = 2000
UNIT_BYTES = 16 << 20
# Ids on a side of a tile of a unit's table, and the share of cells met from which it is counted densely.
TILE = 1024
DENSE = 16
# Ids on a side of the tiles by which counts of all units meet, and words of the corpus for one group of them.
MEETING_TILE = 64
GROUP_WORDS = 1 << 20
# Beyond this many groups the cells of a tile are dealt to several.
GROUPS_OF_TILES = 256
UNKNOWN = "und"

# Fixed values of the contract: what ends a piece, and what stands between words.
BREAKS = b".,;:!?\n\x0b\x0c\r"
GAPS = b" \t"
_PLAIN = bytes.maketrans(BREAKS + GAPS, b"\n" * len(BREAKS) + b" " * len(GAPS))

UNITS = "unit long, lang string, words array<string>, counts array<long>, n_words long, at binary, ids binary"
PLACES = "unit long, lang string, at binary, ids binary"
PACKETS = "g long, unit long, lang string, i binary, j binary, c binary"
WORD_PACKETS = "g long, unit long, lang string, words array<string>, counts array<long>, places binary"
# What a group finds: frequent words or pairs, and for each unit (then with asked) the ids of its own.
MET = "unit long, lang string, word string, id long, i long, j long, f long, asked binary, ids binary"


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def pack(numbers: np.ndarray) -> bytes:
    """Compressed by planes of bytes, in which large numbers of one size mostly repeat."""
    wide = np.ascontiguousarray(numbers, np.int64)
    return zstandard.compress(wide.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64).reshape(-1)


def tokens(text: bytes | None) -> list[bytes]:
    """Words, a line break after each piece, and empty ones between gaps."""
    return (text or b"").lower().translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")


def read_units(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        first, made, size = TaskContext.get().partitionId() << 24, 0, 0

        def flushed() -> Iterator[pa.RecordBatch]:
            nonlocal made
            for lang, (numbers, parts) in held.items():
                ids = np.concatenate(parts)
                ids = ids[ids != 1]
                counts = np.bincount(ids, minlength=len(numbers))[2:]
                at = np.flatnonzero(ids)
                row = [first + made, lang, [w.decode("utf-8", "replace") for w in numbers][2:], counts, len(at), pack(np.diff(at, prepend=0)), pack(ids[at] - 2)]
                made += 1
                kinds = (pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], ["unit", "lang", "words", "counts", "n_words", "at", "ids"])
            held.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                if lang not in held:
                    held[lang] = (_Numbers({b"\n": 0, b"": 1}), [])
                numbers, parts = held[lang]
                parts.append(np.array([*map(numbers.__getitem__, tokens(text)), 0], np.int64))
                size += len(text or b"") + 16
                if size >= UNIT_BYTES:
                    yield from flushed()
                    size = 0
        yield from flushed()

    plain = docs.select(F.col(text_col).cast("string"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)))
    return plain.mapInArrow(gather, UNITS)


def count_pairs(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of ids with their counts."""
    known, places = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b, n = places[: len(i)], places[len(i) :], len(known)
    tiles = -(-n // TILE)
    tile = (a // TILE) * tiles + b // TILE
    cells, counts, sparse = [], [], np.ones(len(a), bool)
    if tiles * tiles <= 1 << 22:
        for t in np.flatnonzero(np.bincount(tile, minlength=tiles * tiles) >= TILE * TILE // DENSE):
            inside = tile == t
            found = np.bincount((a[inside] % TILE) * TILE + b[inside] % TILE)
            met = np.flatnonzero(found)
            cells.append((met // TILE + t // tiles * TILE) * n + met % TILE + t % tiles * TILE)
            counts.append(found[met])
            sparse &= ~inside
    cell, count = np.unique(a[sparse] * n + b[sparse], return_counts=True)
    cell, count = np.concatenate([*cells, cell]), np.concatenate([*counts, count])
    return known[cell // n] if n else cell, known[cell % n] if n else cell, count


def meeting_groups(i: np.ndarray, j: np.ndarray, n_groups: int) -> np.ndarray:
    """Which group counts a pair: by its tile, and with many groups also by its cell."""
    of_cell = (i * 31 + j) % -(-n_groups // GROUPS_OF_TILES)
    x = ((i // MEETING_TILE) * 0x9E3779B1 + (j // MEETING_TILE)).astype(np.uint64) * np.uint64(0xC4CEB9FE1A85EC53) + of_cell.astype(np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((x ^ (x >> np.uint64(33))) % np.uint64(n_groups)).astype(np.int64)


def _neighbours(at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place and ids of two phrases that begin at neighbouring words."""
    next_to = np.flatnonzero(at[1:] == at[:-1] + 1)
    return at[next_to], ids[next_to], ids[next_to + 1]


def _places(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(unpack(row["at"])), unpack(row["ids"])


def _cuts(sorted_numbers: np.ndarray) -> list[tuple[int, int]]:
    starts = np.flatnonzero(np.diff(sorted_numbers, prepend=-1)).tolist()
    return list(zip(starts, [*starts[1:], len(sorted_numbers)]))


def _met(found: list, told: list[tuple]) -> pa.Table:
    """Rows of ``MET``: columns of what is frequent, then rows of unit, asked and ids."""
    none = [None] * len(told)
    asked = [[x[k] for x in told] for k in range(3)]
    kinds = (pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 4, pa.binary(), pa.binary())
    names = ["unit", "lang", "word", "id", "i", "j", "f", "asked", "ids"]
    empty = [None] * len(found[0])
    first, second = [empty, *found, empty, empty], [asked[0], *[none] * 6, *asked[1:]]
    return pa.table([pa.chunked_array([pa.array(x, t), pa.array(y, t)]) for x, y, t in zip(first, second, kinds)], names)


def _ranks(sums: np.ndarray, least: int, n_groups: int, group: int) -> np.ndarray:
    """Ids of what is frequent, -1 for the rest. Each group gives ranks of its own, dealt so that no two
    share one: what is frequent has a small id."""
    frequent = np.flatnonzero(sums >= least)
    ids = np.full(len(sums), -1, np.int64)
    ids[frequent[np.argsort(-sums[frequent], kind="stable")]] = np.arange(len(frequent)) * n_groups + group
    return ids


def met_words(units: DataFrame, n_groups: int, least: int) -> DataFrame:
    """Frequent words with ids, and for each unit the places of its list that hold one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start = zlib.crc32(row["lang"].encode("utf-8", "replace"))
                g = np.array([zlib.crc32(w.encode("utf-8", "replace"), start) for w in row["words"]], np.int64) % n_groups
                order = np.argsort(g, kind="stable")
                words, counts = np.array(row["words"], object)[order], np.array(row["counts"], np.int64)[order]
                out = [(int(g[order[s]]), row["unit"], row["lang"], words[s:e], counts[s:e], pack(np.diff(order[s:e], prepend=0))) for s, e in _cuts(g[order])]
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out), kinds)], ["g", "unit", "lang", "words", "counts", "places"])

    def meet(key: tuple, packets: pa.Table) -> pa.Table:
        numbers, sums, own = {}, [], []
        rows = packets.to_pylist()
        for row in rows:
            at = np.array([numbers.setdefault((row["lang"], w), len(numbers)) for w in row["words"]], np.int64)
            sums.extend([0] * (len(numbers) - len(sums)))
            for k, c in zip(at.tolist(), row["counts"]):
                sums[k] += c
            own.append(at)
        sums = np.array(sums, np.int64)
        ids = _ranks(sums, least, n_groups, key[0].as_py())
        names = list(numbers)
        kept = np.flatnonzero(ids >= 0)
        none = [None] * len(kept)
        found = [[names[k][0] for k in kept], [names[k][1] for k in kept], ids[kept], none, none, sums[kept]]
        told = []
        for row, at in zip(rows, own):
            hit = np.flatnonzero(ids[at] >= 0)
            if len(hit):
                told.append((row["unit"], pack(np.cumsum(unpack(row["places"]))[hit]), pack(ids[at[hit]])))
        return _met(found, told)

    return units.select("unit", "lang", "words", "counts").mapInArrow(count, WORD_PACKETS).groupBy("g").applyInArrow(meet, MET)


def met_pairs(units: DataFrame, n_groups: int, least: int) -> DataFrame:
    """Frequent pairs with new ids, and for each unit the ids of its own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, i, j = _neighbours(*_places(row))
                i, j, c = count_pairs(i, j)
                g = meeting_groups(i, j, n_groups)
                order = np.lexsort((j, i, g))
                g, i, j, c = g[order], i[order], j[order], c[order]
                out = [(int(g[s]), row["unit"], row["lang"], pack(np.diff(i[s:e], prepend=0)), pack(j[s:e]), pack(c[s:e])) for s, e in _cuts(g)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["g", "unit", "lang", "i", "j", "c"])

    def meet(key: tuple, packets: pa.Table) -> pa.Table:
        rows = packets.to_pylist()
        parts = [[np.cumsum(unpack(r["i"])) for r in rows], [unpack(r["j"]) for r in rows], [unpack(r["c"]) for r in rows]]
        of = np.repeat(np.arange(len(rows)), [len(x) for x in parts[0]])
        i, j, c = map(np.concatenate, parts)
        left, a = np.unique(i, return_inverse=True)
        right, b = np.unique(j, return_inverse=True)
        cell = a * len(right) + b
        if len(left) * len(right) > 4 * len(cell):
            cell = np.unique(cell, return_inverse=True)[1]
        sums = np.bincount(cell, weights=c).astype(np.int64)
        own = _ranks(sums, least, n_groups, key[0].as_py())[cell]
        kept = np.flatnonzero(own >= 0)
        one = kept[np.unique(own[kept], return_index=True)[1]]
        langs = np.array([r["lang"] for r in rows], object)[of[one]]
        found = [langs, [None] * len(one), own[one], i[one], j[one], sums[cell[one]]]
        told = [(rows[of[kept[s]]]["unit"], pack(np.concatenate([i[kept[s:e]], j[kept[s:e]]])), pack(own[kept[s:e]])) for s, e in _cuts(of[kept])]
        return _met(found, told)

    return units.mapInArrow(count, PACKETS).groupBy("g").applyInArrow(meet, MET)


def next_places(units: DataFrame, told: DataFrame) -> DataFrame:
    """Where in each unit the phrases begin that have an id on the next level."""

    def put(units: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for row in units.to_pylist():
            at, i, j = _neighbours(*_places(row))
            replies = told.to_pylist()
            if not replies or not len(at):
                continue
            pairs = [unpack(r["asked"]).reshape(2, -1) for r in replies]
            known = np.unique(np.concatenate([i, j]))
            n = len(known)
            left, right = (np.searchsorted(known, np.concatenate([p[k] for p in pairs])) for k in (0, 1))
            new = np.concatenate([unpack(r["ids"]) for r in replies])
            order = np.argsort(left * n + right)
            cells, new = (left * n + right)[order], new[order]
            cell = np.searchsorted(known, i) * n + np.searchsorted(known, j)
            place = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
            hit = np.flatnonzero(cells[place] == cell)
            out.append((row["unit"], row["lang"], pack(np.diff(at[hit], prepend=0)), pack(new[place[hit]])))
        return _unit_table(out)

    return units.groupBy("unit").cogroup(told.groupBy("unit")).applyInArrow(put, PLACES)


def _unit_table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary())
    return pa.table([pa.array(list(x), t) for x, t in zip(zip(*rows) if rows else [()] * 4, kinds)], ["unit", "lang", "at", "ids"])


def word_places(units: DataFrame, told: DataFrame) -> DataFrame:
    """Where in each unit frequent words stand, by their ids."""

    def put(units: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for row in units.to_pylist():
            at, ids = _places(row)
            new = np.full(int(ids.max(initial=-1)) + 1, -1, np.int64)
            for reply in told.to_pylist():
                new[unpack(reply["asked"])] = unpack(reply["ids"])
            hit = np.flatnonzero(new[ids] >= 0)
            out.append((row["unit"], row["lang"], pack(np.diff(at[hit], prepend=0)), pack(new[ids[hit]])))
        return _unit_table(out)

    return units.select("unit", "lang", "at", "ids").groupBy("unit").cogroup(told.groupBy("unit")).applyInArrow(put, PLACES)


def _scores(size: int) -> Column:
    """For each cut its score and where it is; products of whole numbers, up to 38 digits."""
    big = lambda c: c.cast("decimal(19,0)")
    cuts = []
    for k in range(1, size):
        left, right = F.get("heads", F.lit(k - 1)), F.get("tails", F.lit(size - k - 1))
        score = F.call_function("div", big(F.col("f") * F.lit(1000)) * big(F.col("n")), big(left) * big(right))
        cuts.append(F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*cuts))


def mine(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST_COUNT,
    longest: int = LONGEST,
    top: int | None = TOP,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases of 2 to ``longest`` words.

    ``a`` is how often the phrase stands within pieces of text, ``n`` the number of words of the language, ``l`` and
    ``r`` the counts of both parts at the cut with the lowest ``score``, floor(1000 a n / (l r)), the first of equal
    ones. A phrase within a longer one that stands as often is left out. Order: score and ``a`` descending, then
    phrase by bytes; ``top`` of None returns all. A null language is ``und``, a null or empty text has no words,
    repeated rows count again, other columns are not read; an empty table gives no rows. Long texts are read
    whole. Counts of a phrase times the words of its language must stay below 10^35.
    """
    units = stored(read_units(docs, text_col, lang_col), "units")
    sizes = units.groupBy("lang").agg(F.sum("n_words").cast("long").alias("n"))
    n_words = units.agg(F.coalesce(F.sum("n_words"), F.lit(0))).head()[0]
    n_groups = max(1, -(-n_words // GROUP_WORDS))

    told = ["unit", "asked", "ids"]
    met = stored(met_words(units, n_groups, least), "words")
    found = met.where("id IS NOT NULL").select("id", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("f").alias("heads"), F.array("f").alias("tails"))
    places = stored(word_places(units, met.where("asked IS NOT NULL").select(*told)), "places")

    candidates = []
    for size in range(2, longest + 1):
        met = stored(met_pairs(places, n_groups, least), "pairs")
        pairs = met.where("id IS NOT NULL").select("lang", "id", "i", "j", "f")
        parts = [found.select(F.col("id").alias(k), *[F.col(c).alias(f"{k}_{c}") for c in ("phrase", "last", "heads", "tails")]) for k in "ij"]
        longer = pairs.join(parts[0], "i").join(parts[1], "j").select(
            "lang", "id", "i", "j", "f",
            F.concat_ws(" ", "i_phrase", "j_last").alias("phrase"), F.col("j_last").alias("last"),
            F.array_append("i_heads", F.col("f")).alias("heads"), F.array_append("j_tails", F.col("f")).alias("tails"),
        )
        longer = stored(longer, "frequent")
        if candidates:
            candidates[-1] = _outside(candidates[-1], longer)
        candidates.append(longer.withColumn("size", F.lit(size)))
        found = longer
        if size < longest:
            places = stored(next_places(places, met.where("asked IS NOT NULL").select(*told)), "places")

    scored = [c.join(sizes, "lang").select("lang", "phrase", F.col("f").alias("a"), "n", _scores(k).alias("best")) for k, c in enumerate(candidates, 2)]
    rows = reduce(DataFrame.unionByName, scored).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order))
    rows = rows.where(F.col("rank") <= top) if top is not None else rows
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _outside(phrases: DataFrame, longer: DataFrame) -> DataFrame:
    """The phrases that stand more often than any that is one word longer and holds them.

    What a still longer one holds as often, one between holds as often too.
    """
    around = longer.select(F.explode(F.array("i", "j")).alias("id"), "f").groupBy("id").agg(F.max("f").alias("_around"))
    return phrases.join(around, "id", "left").where("_around IS NULL OR _around < f").drop("_around")


#: DuckDB: the same rows, from the contract.
ORACLE_SQL = r"""
WITH pieces AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents)),
grams AS (
    SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
    FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(w) >= m),
counts AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE m >= 2 AND f >= 100),
cut AS (
    SELECT lang, m, phrase, f, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS head,
           array_to_string(string_split(phrase, ' ')[k + 1 : m], ' ') AS tail
    FROM candidates, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k < m),
scored AS (
    SELECT cut.lang, cut.m, cut.phrase, cut.f AS a, k, h.f AS l, t.f AS r, n,
           ((1000::HUGEINT * cut.f * n) // (h.f::HUGEINT * t.f))::BIGINT AS score
    FROM cut JOIN sizes USING (lang)
    JOIN counts h ON h.lang = cut.lang AND h.phrase = head
    JOIN counts t ON t.lang = cut.lang AND t.phrase = tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
    SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM candidates c WHERE c.lang = b.lang AND c.m > b.m AND c.f >= b.a
        AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
