"""Spelling variants: words one edit apart, found in a bit-sliced position index of the vocabulary.

Two words at most one edit apart share the first half of the shorter one, or its second half at their ends,
so words meet in buckets by halves. In a bucket there is a bitset over its words for each position and
letter. A word is looked up in all others at once: bitsets of the words that agree with it so far without an
error, and with one error behind it (a replaced, an additional or a missing letter, the last two read from
shifted positions), are carried from letter to letter by and/or of whole machine words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.common import ship, stored

ship(__name__)

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_CHARS = 6
LEAST_COUNT = 5
# A form stands at least this many times as often as its variant.
FORM_RATIO = 5
# Words that are searched in each other at once; words of one half beyond that go into several blocks.
BUCKET_WORDS = 4096
# Distinct words a task gathers before it sends their counts.
FLUSH = 400_000
# Bytes of one bitset array for a stretch of words that are looked up together.
STRETCH_BYTES = 1 << 18


def count_words(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    slip_every: int | None = None,
) -> DataFrame:
    """``word, n`` of the runs of letters with enough characters and occurrences, A-Z lower-cased.

    With ``slip_every`` an invented slip takes a letter out of one run in so many: h is the CRC-32 of
    ``<id>:<run>``, and where it is divisible the letter at h modulo the length goes. A null text has no
    runs, a null id is written as nothing; repeated rows count again; an empty table gives no words.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            rows = [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())]
            total.clear()
            return pa.RecordBatch.from_arrays(rows, ["word", "n"])

        for batch in batches:
            for text, own in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{own}:".encode() if own is not None else b":")
                # bytes.lower() changes A-Z only.
                for run, n in Counter(RUN.findall((text or b"").lower().decode("utf-8", "replace"))).items():
                    if len(run) < least_chars:
                        continue
                    if slip_every:
                        h = zlib.crc32(run.encode(), start)
                        if h % slip_every == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < least_chars:
                                continue
                    total[run] += n
                if len(total) >= FLUSH:
                    yield flushed()
        if total:
            yield flushed()

    plain = docs.select(F.col(text_col).cast("string"), F.col(id_col))
    counts = plain.mapInArrow(gather, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


def _index(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each position the letters that stand there, and a bitset for each, after one without bits."""
    n_words = len(codes)
    width = -(-n_words // 64)
    index = []
    for p in range(codes.shape[1]):
        letters = np.unique(codes[:, p])
        letters = letters[letters > 0]
        bits = np.zeros((len(letters) + 1, width * 64), bool)
        bits[1:, :n_words] = letters[:, None] == codes[None, :, p]
        index.append((letters, np.packbits(bits, axis=1, bitorder="little").view(np.uint64)))
    return index


def _set_of(chosen: np.ndarray) -> np.ndarray:
    bits = np.zeros(-(-len(chosen) // 64) * 64, bool)
    bits[: len(chosen)] = chosen
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _with_letter(index: list, p: int, letters: np.ndarray) -> np.ndarray:
    """For each letter the words that have it at position ``p``."""
    known, sets = index[p]
    at = np.searchsorted(known, letters)
    at = np.where((at < len(known)) & (known[np.minimum(at, len(known) - 1)] == letters), at + 1, 0) if len(known) else np.zeros(len(letters), np.int64)
    return sets[at]


def _near_sets(index: list, every: np.ndarray, lengths: dict, asked: np.ndarray, size: int) -> np.ndarray:
    """Bitsets of the indexed words one edit away from words of ``size`` letters, of those at least as long
    as the index's shorter ones: of equal length or one longer for short words, one shorter for long ones."""
    short = min(lengths)
    none = np.zeros((len(asked), len(every)), np.uint64)
    exact, replaced, added, missing = none + every, none.copy(), none.copy(), none.copy()
    for i in range(size):
        letters = asked[:, i]
        here = _with_letter(index, i, letters)
        if size == short:
            ahead = _with_letter(index, i + 1, letters) if i + 1 < len(index) else none
            added = (added | exact) & ahead
            replaced = (replaced & here) | exact
        else:
            missing = (missing & _with_letter(index, i - 1, letters)) | exact if i else exact
        exact = exact & here
    if size == short:
        return (replaced & ~exact & lengths[short]) | ((added | exact) & lengths[short + 1])
    return missing & lengths[short]


def _pairs(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bit number of every bit that is set."""
    rows, words = np.nonzero(sets)
    bits = np.unpackbits(sets[rows, words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return rows[at], words[at] * 64 + bit


def search_bucket(size: int, second: bool, words: np.ndarray, n: np.ndarray, keys: np.ndarray, asked: np.ndarray, held: np.ndarray) -> list[tuple]:
    """``word, n_near, form_n, form`` of the asked words that have near ones among the held.

    Words have ``size`` or one more letters; those that both have one more are compared in the next size,
    and pairs that share the first half are not counted in the bucket of their second.
    """
    codes = words.astype(f"<U{size + 1}").view(np.uint32).reshape(len(words), size + 1)
    length = (codes > 0).sum(axis=1)
    inside, half = np.flatnonzero(held), size // 2
    index, every = _index(codes[inside]), _set_of(np.ones(len(inside), bool))
    lengths = {size + k: _set_of(length[inside] == size + k) for k in (0, 1)}
    found = []
    for of in (size, size + 1):
        mine = np.flatnonzero(asked & (length == of))
        step = max(16, STRETCH_BYTES // (8 * len(every))) if len(every) else 1
        for a in range(0, len(mine) if len(inside) else 0, step):
            stretch = mine[a : a + step]
            q, w = _pairs(_near_sets(index, every, lengths, codes[stretch], of))
            q, w = stretch[q], inside[w]
            same = keys[q] == keys[w]
            if second:
                same &= (codes[q, :half] != codes[w, :half]).any(axis=1)
            q, w = q[same], w[same]
            order = np.lexsort((words[w], -n[w], q))
            q, w = q[order], w[order]
            starts = np.flatnonzero(np.diff(q, prepend=-1))
            for s, e in zip(starts, [*starts[1:], len(q)]):
                found.append((str(words[q[s]]), int(e - s), int(n[w[s]]), str(words[w[s]])))
    return found


def _halves(word: Column) -> Column:
    """The buckets of a word: as the shorter or an equal one, and as the longer of a pair."""
    size = F.length(word)
    places = []
    for shorter in (0, 1):
        c = size - shorter
        p = F.floor(c / 2).cast("int")
        places.append(F.struct(c.alias("c"), F.lit(False).alias("second"), F.substring(word, F.lit(1), p).alias("key")))
        places.append(F.struct(c.alias("c"), F.lit(True).alias("second"), F.substring(word, size - c + p + 1, c - p).alias("key")))
    return F.array(*places)


def near_words(words: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``word, n_near, form_n, form`` for the words (``word, n``, distinct) that have any near word.

    Near: one letter inserted, deleted or replaced. ``form`` is the near word of largest ``n``, ties to the
    first by code points. Halves that many words share are searched block by block, so that no task holds
    more than two blocks.
    """
    rows = words.select("word", "n", F.explode(_halves(F.col("word"))).alias("at"))
    rows = stored(rows.select("word", "n", "at.*").where((F.col("c") >= least_chars)), "halves")
    of_class = rows.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / (2 * BUCKET_WORDS)).alias("_parts"))
    crowded = rows.groupBy("c", "second", "key").agg(F.ceil(F.count(F.lit(1)) / BUCKET_WORDS).cast("int").alias("_blocks")).where("_blocks > 1")
    placed = rows.join(of_class, "c").join(crowded, ["c", "second", "key"], "left")
    code = F.xxhash64("key")
    zero = F.lit(0)
    single = placed.where("_blocks IS NULL").select(
        "c", "second", F.pmod(code, F.col("_parts")).alias("g"), zero.alias("i"), zero.alias("j"), "key", "word", "n", F.lit(True).alias("asked"), F.lit(True).alias("held")
    )
    own = F.pmod(F.xxhash64("word"), F.col("_blocks")).cast("int")
    spread = placed.where("_blocks IS NOT NULL").select("*", own.alias("_own"), F.explode(F.sequence(zero, F.col("_blocks") - 1)).alias("_x"))
    # The hash is negative, so that it is no other bucket's number.
    apart = -1 - F.pmod(code, F.lit(2**62))
    blocks = [
        spread.select("c", "second", apart.alias("g"), F.col(i).alias("i"), F.col(j).alias("j"), "key", "word", "n", F.lit(asks).alias("asked"), F.lit(not asks).alias("held"))
        for i, j, asks in (("_own", "_x", True), ("_x", "_own", False))
    ]

    def search(key: tuple, table: pa.Table) -> pa.Table:
        columns = {name: table.column(name).to_numpy() for name in ("n", "asked", "held")}
        texts = [np.array(table.column(name).to_pylist(), str) for name in ("word", "key")]
        found = search_bucket(key[0].as_py(), key[1].as_py(), texts[0], columns["n"], texts[1], columns["asked"], columns["held"])
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(list(x), t) for x, t in zip(zip(*found) if found else [()] * 4, kinds)], ["word", "n_near", "form_n", "form"])

    every = single.unionByName(blocks[0]).unionByName(blocks[1])
    found = every.groupBy("c", "second", "g", "i", "j").applyInArrow(search, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    both = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return both.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def _roots(links: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form; each step doubles how far a link reaches.

    A form is ``FORM_RATIO`` times as frequent, so chains are short and have no circles.
    """
    at = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = stored(at.join(onward, "root", "left"), "roots")
        at = joined.select("word", F.coalesce("_next", "root").alias("root"))
        if joined.where("_next IS NOT NULL").limit(1).count() == 0:
            return at


def group_variants(words: DataFrame, least_chars: int = LEAST_CHARS, ratio: int = FORM_RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of ``word, n``.

    Words are distinct and have at least ``least_chars`` (2 or more) letters. ``form`` is the most frequent near
    word if it is at least ``ratio`` times as frequent, else null; ``root`` is the end of the chain of forms,
    the word itself without one. Other columns of ``words`` are dropped; no words give no rows.
    """
    words = stored(words.select("word", "n"), "words")
    near = stored(near_words(words, least_chars), "near")
    rows = words.join(near, "word", "left")
    frequent = F.col("form_n") >= ratio * F.col("n")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(frequent, F.col("form")).alias("form"), F.when(frequent, F.col("form_n")).alias("form_n")
    )
    rows = stored(rows, "forms")
    rows = rows.join(_roots(rows.where("form IS NOT NULL")), "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
