"""Scoring texts with a causal self-attention model on subword ids.

The model is trained here, in numpy. Words (A-Z in lower case) are spelled in the ids of a public
byte-level tokenizer, one word at a time with the space before it, and a text ends with the end-of-text
id. A layer of causal self-attention with learned relative positions reads the ids before a position, and
an output layer gives the next one: frequent ids each have an output, the others share outputs by their
frequency and are told apart within by counts. Texts are cut into windows that overlap; a window's first
positions are context only, so that every id is scored exactly once, and windows of many texts are run
together with a causal mask.

The network starts on the driver with a bounded draw of training documents and then learns from every other one
in rounds: the documents of a round are dealt into shards by row hash, every shard goes on learning from the same
network, and the shards' networks are averaged, each row of the tables by how often a shard met its id.

Counts of whole words are taken over all training documents. A word's probability is a mixture of its
share of these counts and of the product of its ids' probabilities; the mixture's weight is fitted to
all training documents of the rounds, each as the network scores it before learning from it.

How words meet their counts: words that make up at least one in 1,048,576 of all words are at most that many
and are broadcast. Every other word of a document is joined with its count; no such word holds more than
that fraction of the rows, so the join has no hot key.
"""

from __future__ import annotations

import base64
import copy
import functools
import itertools
import math
import struct
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T

from pairloom.llm.common import Parcel, fresh, row_hash, ship, stored

ship(__name__)

FREQUENT = 1 << 20  # words with at least this fraction of all words are broadcast
SAMPLE_DOCS = 1200  # training documents that the network starts with; all others follow in rounds
DEV_DOCS = 200  # where there are few documents, this many to SAMPLE_DOCS are left to the rounds
SHARD_DOCS = 4096  # documents, about, that a copy of the network learns from in a round
ROUNDS = 4  # rounds, where there are that many shards
RATE = 0.006  # the learning rate of the first round
LOT_IDS = 250_000  # ids that a copy takes up at a time
CHOICES = np.linspace(0.05, 0.95, 19)  # weights tried for the mixture
INPUTS = 2048  # most frequent ids with an own embedding
OUTPUTS = 96  # outputs, of which SHARED stand for several ids each
SHARED = 32
WIDTH = 16
WINDOW = 32  # ids in a window
OVERLAP = 8  # of these, context of the later ones
BATCH = 64  # windows run together, few enough for a core's cache
CACHE_WORDS = 300_000
COUNTED = 400_000  # distinct words that a task counts before passing them on


def words_of(text: str | None) -> list[bytes]:
    """``bytes.split`` splits at space and tab to carriage return, ``bytes.lower`` changes A-Z."""
    return (text or "").encode("utf-8", "replace").lower().split()


class Spelling(dict):
    """A word's ids, packed, with the space before it; filled as words are met."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.end = max(ranks.values()) + 1  # the id after the last, which no word is spelled with
        self.size = self.end + 1
        self.encode = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def __reduce__(self):
        return Spelling, (self.ranks,)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > CACHE_WORDS:
            self.clear()
        ids = self.encode(" " + word.decode("utf-8", "replace"))
        packed = self[word] = array("I", ids).tobytes()
        return packed


def load_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a ``.tiktoken`` file; it is small and read by the driver."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@dataclass
class Attention:
    """Tables of queries, keys, values and inputs per id, and the output layer."""

    input_of: np.ndarray  # id -> row of the tables
    output_of: np.ndarray  # id -> output
    inside: np.ndarray  # id -> log10 of its share of the output
    tables: np.ndarray  # (inputs, 4 * width): query, key, value, residual
    bias: np.ndarray  # (window,): by distance to the id looked at
    output: np.ndarray  # (width + 1, outputs)

    def mask(self) -> np.ndarray:
        distance = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]
        return np.where(distance >= 0, self.bias[np.clip(distance, 0, None)], -1e9).astype(np.float32)

    def inputs(self, rows: np.ndarray, at: np.ndarray, fresh_start: np.ndarray, end: int) -> np.ndarray:
        """What windows read: before each position the id there, and the end at a sequence's start."""
        return np.where(fresh_start, self.input_of[end], rows[np.maximum(at - 1, 0)])

    def forward(self, rows: np.ndarray, mask: np.ndarray, skip: int = 0):
        """Hidden states after each position of windows (number, window) but the first ``skip``."""
        looked = self.tables.take(rows, axis=0)
        query, key, value, rest = (looked[:, :, k * WIDTH : (k + 1) * WIDTH] for k in range(4))
        query, rest = query[:, skip:], rest[:, skip:]
        weight = np.matmul(query, key.transpose(0, 2, 1))
        weight *= WIDTH**-0.5
        weight += mask[skip:]
        np.minimum(weight, 60, out=weight)
        np.exp(weight, out=weight)
        weight /= weight @ np.ones((weight.shape[2], 1), np.float32)
        mixed = np.matmul(weight, value)
        mixed += rest
        hidden = np.tanh(mixed)
        return hidden, weight, looked

    def log10(self, rows: np.ndarray, targets: np.ndarray, counted: np.ndarray, mask: np.ndarray, skip: int = 0) -> np.ndarray:
        """log10 probability of the targets at the counted positions, in order; the first ``skip`` are not."""
        hidden, _, _ = self.forward(rows, mask, skip)
        hidden, targets = hidden[counted[:, skip:]], targets[counted]
        logits = hidden @ self.output[:-1]
        logits += self.output[-1]
        right = logits[np.arange(len(logits)), targets]
        np.exp(logits, out=logits)  # bounded: hidden states lie between -1 and 1
        return (right - np.log(logits @ np.ones(logits.shape[1], np.float32))) / math.log(10)


def lay_out(ids: np.ndarray, lengths: np.ndarray):
    """Windows over sequences laid end to end, and where in ``ids`` each scored position is.

    The input of a position is the id before it; a sequence starts after the end-of-text id. A
    sequence's first window scores all its positions, every later one those after the overlap.
    """
    step = WINDOW - OVERLAP
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    number = 1 + np.maximum(0, -(-(lengths - WINDOW) // step))
    owner = np.repeat(np.arange(len(lengths)), number)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    place = (nth * step)[:, None] + np.arange(WINDOW)[None, :]
    inside = place < lengths[owner][:, None]
    at = np.where(inside, place + starts[owner][:, None], 0)
    counted = inside & ((np.arange(WINDOW)[None, :] >= OVERLAP) | (nth == 0)[:, None])
    fresh_start = place == 0
    return at, counted, fresh_start


def score_ids(net: Attention, ids: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """log10 probability of each id given those before it in its sequence."""
    result = net.inside[ids].astype(np.float32)
    if not len(ids):
        return result
    at, counted, fresh_start = lay_out(ids, lengths)
    rows, outputs, mask = net.input_of[ids], net.output_of[ids], net.mask()
    # The overlap that later windows begin with is context: nothing is asked there.
    first = fresh_start[:, 0]
    for windows, skip in ((np.flatnonzero(first), 0), (np.flatnonzero(~first), OVERLAP)):
        for start in range(0, len(windows), BATCH):
            picked = windows[start : start + BATCH]
            some, keep = at[picked], counted[picked]
            inputs = net.inputs(rows, some, fresh_start[picked], end)
            result[some[keep]] += net.log10(inputs, outputs[some], keep, mask, skip)
    return result


def new_network(ids: np.ndarray, size: int, seed: int = 3, counts: np.ndarray | None = None) -> Attention:
    """An untrained network whose inputs and outputs are laid out by the counts of all ids, by default those
    of the given sequence."""
    counts = (np.bincount(ids, minlength=size) if counts is None else counts) + 0.01
    order = np.argsort(-counts, kind="stable")
    input_of = np.full(size, min(INPUTS, size) - 1, np.int32)
    input_of[order[: INPUTS - 1]] = np.arange(min(INPUTS - 1, size))
    output_of = np.empty(size, np.int32)
    alone = min(OUTPUTS - SHARED, size)
    output_of[order[:alone]] = np.arange(alone)
    rest = order[alone:]
    if len(rest):
        # Outputs with about the same share of the remaining counts.
        edges = np.cumsum(counts[rest]) / counts[rest].sum()
        output_of[rest] = alone + np.minimum((edges * SHARED).astype(int), SHARED - 1)
    totals = np.bincount(output_of, weights=counts, minlength=OUTPUTS)
    inside = np.log10(counts / totals[output_of])
    draw = np.random.default_rng(seed)
    tables = (draw.standard_normal((INPUTS, 4 * WIDTH)) * 0.3).astype(np.float32)
    output = (draw.standard_normal((WIDTH + 1, OUTPUTS)) * 0.1).astype(np.float32)
    output[-1] = np.log(np.maximum(totals, 1e-3) / totals.sum())
    return Attention(input_of, output_of, inside, tables, np.zeros(WINDOW, np.float32), output)


class Learner:
    """Adam on the cross entropy of the next output, through attention and tables; a step moves the rows it read."""

    def __init__(self, net: Attention):
        self.net, self.steps = net, 0
        self.weights = [net.tables, net.bias, net.output]
        self.moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights]
        self.met = np.zeros(len(net.tables), np.int64)  # how often a row of the tables was read
        self.distance = np.clip(np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :], 0, None).ravel()

    def step(self, inputs: np.ndarray, targets: np.ndarray, counted: np.ndarray, rate: float) -> np.ndarray:
        """One step on windows; log10 probability of the targets at the counted positions, before it."""
        net, scale = self.net, WIDTH**-0.5
        hidden, weight, looked = net.forward(inputs, net.mask())
        query, key, value, _ = (looked[:, :, k * WIDTH : (k + 1) * WIDTH] for k in range(4))
        # Other positions have no slope.
        flat, asked = hidden[counted], targets[counted]
        slope = flat @ net.output[:-1]
        slope += net.output[-1]
        places = np.arange(len(slope)), asked
        right = slope[places]
        np.exp(slope, out=slope)  # bounded: hidden states lie between -1 and 1
        total = slope @ np.ones(slope.shape[1], np.float32)
        slope *= (1 / (total * max(len(slope), 1)))[:, None]
        slope[places] -= np.float32(1 / max(len(slope), 1))
        d_output = np.concatenate([flat.T @ slope, slope.sum(axis=0, keepdims=True)])
        d_mixed = np.zeros_like(hidden)
        d_mixed[counted] = slope @ net.output[:-1].T
        d_mixed *= 1 - hidden**2
        d_looked = np.empty_like(looked)
        d_weight = np.matmul(d_mixed, value.transpose(0, 2, 1))
        d_weight -= (d_weight * weight) @ np.ones((WINDOW, 1), np.float32)
        d_weight *= weight
        d_bias = np.bincount(self.distance, weights=np.tril(d_weight.sum(axis=0)).ravel(), minlength=WINDOW)
        d_looked[:, :, :WIDTH] = np.matmul(d_weight, key) * scale
        d_looked[:, :, WIDTH : 2 * WIDTH] = np.matmul(d_weight.transpose(0, 2, 1), query) * scale
        d_looked[:, :, 2 * WIDTH : 3 * WIDTH] = np.matmul(weight.transpose(0, 2, 1), d_mixed)
        d_looked[:, :, 3 * WIDTH :] = d_mixed
        used = inputs.ravel().astype(np.uint16)
        by = np.argsort(used, kind="stable")
        first = np.concatenate([[0], np.flatnonzero(np.diff(used[by])) + 1])
        read = used[by][first]
        d_tables = np.add.reduceat(d_looked.reshape(-1, 4 * WIDTH).take(by, axis=0), first, axis=0)
        self.met += np.bincount(used, minlength=len(self.met))
        self.steps += 1
        slopes = (read, d_tables), (slice(None), d_bias.astype(np.float32)), (slice(None), d_output)
        for w, (at, s), (means, squares) in zip(self.weights, slopes, self.moments):
            mean = means[at] = means[at] + 0.1 * (s - means[at])
            square = squares[at] = squares[at] + 0.01 * (s * s - squares[at])
            w[at] -= rate * (mean / (1 - 0.9**self.steps)) / (np.sqrt(square / (1 - 0.99**self.steps)) + 1e-8)
        return (right - np.log(total)) / math.log(10)

    def over(self, ids: np.ndarray, lengths: np.ndarray, end: int, rates: Iterator[float], batch: int, draw: np.random.Generator) -> np.ndarray:
        """Steps on all windows over sequences, in drawn order; each id's log10 probability just before its step."""
        at, counted, fresh_start = lay_out(ids, lengths)
        rows, outputs = self.net.input_of[ids], self.net.output_of[ids]
        result = self.net.inside[ids].astype(np.float32)
        order = draw.permutation(len(at))
        for start in range(0, len(order), batch):
            picked = order[start : start + batch]
            some, keep = at[picked], counted[picked]
            inputs = self.net.inputs(rows, some, fresh_start[picked], end)
            result[some[keep]] += self.step(inputs, outputs[some], keep, next(rates))
        return result


def train(net: Attention, ids: np.ndarray, lengths: np.ndarray, end: int, epochs: int = 3, batch: int = 192, seed: int = 5) -> Attention:
    """The network after some passes over sequences, at a falling rate."""
    learner, draw = Learner(net), np.random.default_rng(seed)
    total = epochs * -(-len(lay_out(ids, lengths)[0]) // batch)
    rates = (0.02 * (1 - 0.95 * step / total) for step in range(1, total + 1))
    for _ in range(epochs):
        learner.over(ids, lengths, end, rates, batch, draw)
    return net


@dataclass
class LanguageModel:
    """The network, the counts of frequent words, and how both are mixed."""

    spelling: Spelling
    net: Attention
    frequent: dict[bytes, int]
    tokens: int
    distinct: int
    ends: int  # documents learned from, each with one end
    share: float = 0.5  # weight of the word counts

    @property
    def end(self) -> int:
        return self.spelling.end

    def base(self, count: int) -> float:
        return math.log10((count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def spelled(self, texts: list[list[bytes]], scored: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> list[np.ndarray]:
        """log10 probability by the network of each word, the end last; per text.

        ``scored`` gives that of each id of sequences, by default the network as it stands.
        """
        packed, sizes, lengths = [], [], []
        end = struct.pack("<I", self.end)
        for words in texts:
            parts = list(map(self.spelling.__getitem__, words))
            parts.append(end)
            packed += parts
            n = [len(p) >> 2 for p in parts]
            sizes += n
            lengths.append(sum(n))
        ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
        lengths = np.array(lengths, np.int64)
        scores = scored(ids, lengths) if scored else score_ids(self.net, ids, lengths, self.end)
        sizes = np.array(sizes, np.int64)
        # A word of which nothing is spelled has no ids; sums over empty stretches are 0.
        sums = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
        ends = np.cumsum(sizes)
        per_word = sums[ends] - sums[ends - sizes]
        counts = np.cumsum([0, *[len(w) + 1 for w in texts]])
        return [per_word[a:b] for a, b in zip(counts, counts[1:])]

    def mixed(self, count: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """log10 of the mixture. As in the base score, what was never counted has half a count."""
        counted = (count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))
        return np.log10(self.share * counted + (1 - self.share) * 10.0 ** np.maximum(spelled, -280))


def count_words(docs: DataFrame, text: str, learn: str) -> DataFrame:
    """``word, c, every``: occurrences in rows to learn from, and in all rows; the end left out.

    A task adds its words up before they are shuffled, and passes them on when it holds many.
    """

    def emit(known: Counter, every: Counter) -> pa.RecordBatch:
        words = list(every)
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array([known[w] for w in words], pa.int64()), pa.array(list(every.values()), pa.int64())],
            names=["word", "c", "every"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, every = Counter(), Counter()
        for batch in batches:
            for t, learned in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(t)
                every.update(words)
                if learned:
                    known.update(words)
                if len(every) > COUNTED:
                    yield emit(known, every)
                    known, every = Counter(), Counter()
        yield emit(known, every)

    parts = docs.select(text, learn).mapInArrow(run, "word binary, c long, every long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("every").alias("every"))


def count_ids(counts: DataFrame, spelling: Spelling) -> np.ndarray:
    """How often each id spells the words of ``count_words``: one number for each id of the vocabulary.

    A task spells each of its distinct words once and sends one row for an id.
    """
    shared = counts.sparkSession.sparkContext.broadcast(Parcel(spelling))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell, found = shared.value, np.zeros(shared.value.size, np.int64)
        for batch in batches:
            packed = [spell[w] for w in batch.column(0).to_pylist()]
            ids = np.frombuffer(b"".join(packed), "<u4")
            np.add.at(found, ids, np.repeat(batch.column(1).to_numpy(), [len(p) >> 2 for p in packed]))
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(found[used])], names=["id", "n"])

    rows = counts.where("c > 0").select("word", "c").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(spelling.size, np.float64)
    total[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return total


def mixture_sums(model: LanguageModel, count: np.ndarray, spelled: np.ndarray) -> np.ndarray:
    """For each of ``CHOICES`` as the word counts' weight, the sum of the words' log probabilities."""
    counted = ((count + 0.5) / (model.tokens + 0.5 * (model.distinct + 1))).astype(np.float32)
    # Never far below the counts' part, so nothing is lost in single precision.
    spelled = 10.0 ** np.maximum(spelled, -30).astype(np.float32)
    return np.array([np.log(np.float32(c) * counted + np.float32(1 - c) * spelled).sum(dtype=np.float64) for c in CHOICES])


def learn_round(docs: DataFrame, model: LanguageModel, shards: int, rate: tuple[float, float]) -> DataFrame:
    """One round over ``_t, _draw, _shard``: rows of learned weights, what the mixture is fitted to, and rare words.

    The rows of a shard are learned from in the order of their hashes, whatever partition they came from, so the
    result does not depend on how the table is stored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Parcel(model))
    schema = "row int, met long, weights array<float>, sums array<double>, word binary, own long, p float"
    names = ["row", "met", "weights", "sums", "word", "own", "p"]
    kinds = [pa.int32(), pa.int64(), pa.list_(pa.float32()), pa.list_(pa.float64()), pa.binary(), pa.int64(), pa.float32()]

    def rows_of(**known: list) -> pa.RecordBatch:
        size = len(next(iter(known.values())))
        return pa.RecordBatch.from_arrays([pa.array(known.get(n, [None] * size), k) for n, k in zip(names, kinds)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel = shared.value
        learner, shard, seen, lot, held = None, None, 0, [], 0

        def learn_lot() -> Iterator[pa.RecordBatch]:
            share = min(1.0, seen / SHARD_DOCS)
            now = rate[0] + (rate[1] - rate[0]) * share
            spelled = m.spelled(lot, lambda ids, lengths: learner.over(ids, lengths, m.end, itertools.repeat(now), 192, draw))
            sums, rare = np.zeros(len(CHOICES)), []
            for words, s in zip(lot, spelled):
                # A document was counted itself: its own occurrences are taken off.
                own = Counter(words)
                count = np.array([m.frequent.get(w, own[w] - 1) - own[w] for w in words] + [m.ends - 1], np.float64)
                found = count >= 0
                found[-1] = True
                sums += mixture_sums(m, count[found], s[found])
                rare += [(words[k], own[words[k]], s[k]) for k in np.flatnonzero(~found)]
            yield rows_of(sums=[sums])
            for start in range(0, len(rare), 50_000):
                word, own, p = zip(*rare[start : start + 50_000])
                yield rows_of(word=word, own=own, p=np.array(p, np.float32))

        def hand_on() -> Iterator[pa.RecordBatch]:
            net = learner.net
            used = np.flatnonzero(learner.met)
            whole = learner.met.sum()
            yield rows_of(
                row=[*used, len(net.tables), len(net.tables) + 1], met=[*learner.met[used], whole, whole],
                weights=[*net.tables[used], net.bias, net.output.ravel()],
            )

        for whole in batches:
            for number, text in zip(whole.column(0).to_pylist(), whole.column(1)):
                if number != shard:
                    if lot:
                        yield from learn_lot()
                    if learner is not None:
                        yield from hand_on()
                    shard, seen, lot, held = number, 0, [], 0
                    learner, draw = Learner(copy.deepcopy(m.net)), np.random.default_rng(number)
                words = words_of(text.as_py())
                lot.append(words)
                seen += 1
                held += sum(map(len, words)) // 4 + len(words) + 1  # about as many ids
                if held >= LOT_IDS:
                    yield from learn_lot()
                    lot, held = [], 0
        if lot:
            yield from learn_lot()
        if learner is not None:
            yield from hand_on()

    dealt = docs.repartitionById(shards, "_shard").sortWithinPartitions("_shard", "_draw", "_t").select("_shard", "_t")
    result = stored(dealt.mapInArrow(run, schema), "learned")
    shared.unpersist()
    return result


def averaged(net: Attention, learned: DataFrame) -> Attention:
    """The network of averaged weights: each row of the tables by how often a shard met its id."""
    cells = learned.where("row is not null").select("row", "met", F.posexplode("weights").alias("at", "w"))
    means = cells.groupBy("row", "at").agg((F.sum(F.col("w").cast("double") * F.col("met")) / F.sum("met")).alias("w")).toArrow()
    row, at, w = (means[c].to_numpy() for c in ("row", "at", "w"))
    net = copy.deepcopy(net)
    size = len(net.tables)
    for target, mine in ((net.bias, row == size), (net.output.reshape(-1), row == size + 1)):
        target[at[mine]] = w[mine]
    mine = row < size
    net.tables[row[mine], at[mine]] = w[mine]
    return net


def fit(docs: DataFrame, tokenizer: str, text: str, learn: str) -> tuple[LanguageModel, DataFrame]:
    """The model, and the stored table of word counts.

    ``learn`` names a boolean column: rows that counts, network and mixture come from. The counts of words and of
    ids, by which the network's inputs and outputs are laid out and ids are told apart within an output, are those
    of all these rows. The network learns from at most ``SAMPLE_DOCS`` of them on the driver, to begin with, and
    from each of the others once, in rounds over Spark. The mixture's weight is fitted to all of the others.
    """
    spark = docs.sparkSession
    counts = stored(count_words(docs, text, learn), "word-counts")
    n_docs = docs.agg(F.count_if(F.col(learn)).alias("n")).head().n
    total = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.coalesce(F.sum("every"), F.lit(0)).alias("every"),
        F.count_if(F.col("c") > 0).alias("v"),
    ).head()
    # At most FREQUENT words can have this many occurrences: they add up to `every`.
    least = max(1, -(-total.every // FREQUENT))
    rows = counts.where(F.col("every") >= least).select("word", "c").toArrow()
    frequent = dict(zip(rows["word"].to_pylist(), rows["c"].to_pylist()))

    # To begin with: rows before the first hash that would be one too many, and fewer of few documents.
    wanted = SAMPLE_DOCS + DEV_DOCS
    position = F.pmod(row_hash(*docs.columns), F.lit(1 << 40)).alias("_draw")
    learned = docs.where(F.col(learn)).select(F.coalesce(F.col(text), F.lit("")).alias("_t"), position)
    bound = min(1.0, 3 * wanted / max(n_docs, 1)) * (1 << 40)
    draws = [r._draw for r in learned.where(F.col("_draw") < bound).select("_draw").orderBy("_draw").limit(wanted).collect()]
    begin = len(draws) * SAMPLE_DOCS // wanted
    until = draws[begin] if draws else 0
    begin = draws.index(until) if draws else 0
    texts = [words_of(r._t) for r in learned.where(F.col("_draw") < until).orderBy("_draw", "_t").limit(begin).collect()]

    model = LanguageModel(Spelling(load_ranks(tokenizer)), None, frequent, total.c + n_docs, total.v + (n_docs > 0), n_docs)
    end = struct.pack("<I", model.end)
    packed = [b"".join([*map(model.spelling.__getitem__, words), end]) for words in texts]
    ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
    lengths = np.array([len(p) >> 2 for p in packed], np.int64)
    id_counts = count_ids(counts, model.spelling)
    id_counts[model.end] += n_docs
    model.net = new_network(ids, model.spelling.size, counts=id_counts)
    if len(ids):
        train(model.net, ids, lengths, model.end)

    left = n_docs - len(texts)
    shards = -(-left // SHARD_DOCS)
    rounds = min(ROUNDS, shards)
    met = []
    for k in range(rounds):
        at_once = -(-shards // rounds)
        place = F.pmod(F.col("_draw"), F.lit(rounds * at_once))
        mine = learned.where((F.col("_draw") >= until) & (F.pmod(F.col("_draw"), F.lit(rounds)) == k))
        mine = mine.withColumn("_shard", F.floor(place / rounds).cast("int"))
        rate = tuple(RATE * (1 - 0.9 * (k + done) / rounds) for done in (0, 1))
        met.append(learn_round(mine, model, at_once, rate))
        model.net = averaged(model.net, met[-1])
    if met:
        model.share = fitted_share(model, counts, functools.reduce(DataFrame.unionAll, met))
    return model, counts


def fitted_share(model: LanguageModel, counts: DataFrame, met: DataFrame) -> float:
    """The best of ``CHOICES``, by all words of the rounds' documents; rare words are joined with their counts."""
    sums = np.zeros(len(CHOICES))
    parts = met.where("sums is not null").select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s"))
    for r in parts.collect():
        sums[r["at"]] = r.s
    scale = F.lit(model.tokens + 0.5 * (model.distinct + 1))
    counted = (F.greatest(F.coalesce("c", F.lit(0)) - F.col("own"), F.lit(0)) + 0.5) / scale
    rare = met.where("word is not null").select("word", "own", F.pow(F.lit(10.0), F.greatest(F.col("p").cast("double"), F.lit(-280.0))).alias("p"))
    rare = rare.join(counts.select("word", "c"), "word", "left").select(counted.alias("q"), "p")
    logs = [F.sum(F.ln(F.lit(float(c)) * F.col("q") + F.lit(float(1 - c)) * F.col("p"))).alias(f"s{k}") for k, c in enumerate(CHOICES)]
    sums += np.array([s or 0.0 for s in rare.agg(*logs).head()])
    return float(CHOICES[int(np.argmax(sums))])


def score(docs: DataFrame, model: LanguageModel, counts: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_tokens``, ``n_known``, ``base_score`` and ``lm_score`` of every whole text.

    A null text has no words, only the end. Rows and all columns but the text stay, repeated rows too, each
    scored for itself; a clashing name makes the new column's get an underscore.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Parcel(model))
    row, *own = fresh(docs, "_row", "_tokens", "_known", "_base", "_score", "_rare")
    schema = T.StructType([
        *docs.schema.fields,
        T.StructField(own[0], T.LongType()), T.StructField(own[1], T.LongType()),
        T.StructField(own[2], T.DoubleType()), T.StructField(own[3], T.DoubleType()),
        T.StructField(own[4], T.ArrayType(T.StructType([T.StructField("w", T.BinaryType()), T.StructField("p", T.FloatType())]))),
    ])
    place = docs.columns.index(text)
    carried = [c for c in docs.columns if c != text]
    kept_schema = T.StructType([f for f in schema.fields if f.name != text])
    rare_type = pa.list_(pa.struct([("w", pa.binary()), ("p", pa.float32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: LanguageModel = shared.value
        get = m.frequent.get
        scale = m.tokens + 0.5 * (m.distinct + 1)
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                texts = [words_of(t) for t in batch.column(place).to_pylist()]
                spelled = m.spelled(texts)
                tokens, known, base, total, rare_at, rare_w, rare_p = [], [], [], [], [0], [], []
                for words, s in zip(texts, spelled):
                    count = np.array([get(w, -1) for w in words] + [m.ends], np.float64)
                    found = count >= 0
                    there = count[found]
                    tokens.append(len(words) + 1)
                    known.append(int((there > 0).sum()))
                    base.append(float(np.log10((there + 0.5) / scale).sum()))
                    total.append(float(m.mixed(there, s[found]).sum()))
                    for k in np.flatnonzero(~found):
                        rare_w.append(words[k])
                        rare_p.append(s[k])
                    rare_at.append(len(rare_w))
                rare = pa.ListArray.from_arrays(
                    pa.array(rare_at, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(rare_w, pa.binary()), pa.array(np.array(rare_p, np.float32))], ["w", "p"]),
                )
                others = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if i != place]
                yield pa.RecordBatch.from_arrays(
                    [*[c for _, c in others], pa.array(tokens, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(base, pa.float64()), pa.array(total, pa.float64()), rare.cast(rare_type)],
                    names=[*[n for n, _ in others], *own],
                )

    first = stored(docs.mapInArrow(run, kept_schema).withColumn(row, F.monotonically_increasing_id()), "scored")
    scale = F.lit(model.tokens + 0.5 * (model.distinct + 1))
    rare = first.select(row, F.explode(own[4]).alias("r")).select(row, F.col("r.w").alias("word"), F.col("r.p").cast("double").alias("p"))
    count = F.coalesce("c", F.lit(0))
    share = F.lit(model.share)
    counted = (count + 0.5) / scale
    added = (
        rare.join(counts.select("word", "c"), "word", "left")
        .groupBy(row)
        .agg(
            F.count_if(count > 0).alias("_k"),
            F.sum(F.log10((count + 0.5) / scale)).alias("_b"),
            F.sum(F.log10(share * counted + (1 - share) * F.pow(F.lit(10.0), F.greatest("p", F.lit(-280.0))))).alias("_s"),
        )
    )
    names = fresh(docs, "n_tokens", "n_known", "base_score", "lm_score")
    return first.join(added, row, "left").select(
        *carried,
        F.col(own[0]).alias(names[0]),
        (F.col(own[1]) + F.coalesce("_k", F.lit(0))).alias(names[1]),
        (F.col(own[2]) + F.coalesce("_b", F.lit(0.0))).alias(names[2]),
        (F.col(own[3]) + F.coalesce("_s", F.lit(0.0))).alias(names[3]),
    )
