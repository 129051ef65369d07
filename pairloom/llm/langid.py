"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in both directions and gives every position
probabilities of the languages; a document's are the mean over its positions. It is trained here, in
numpy, by backpropagation through time with Adam, on a bounded sample of labelled documents. Texts of
any length are read whole: in windows that overlap, so that each position has context on both sides
and is labelled in exactly one window. Letters in either case share their weights.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pairloom.llm.common import Parcel, fresh, row_hash, ship

ship(__name__)

UNDETERMINED = "und"

HIDDEN = 8  # units in each direction
SPAN = 112  # positions that a window labels
CONTEXT = 8  # positions that it reads besides, on each side
WINDOWS = 2048  # windows that are run together
TRAIN_PER_LANGUAGE = 400  # documents per language in the training sample
MAX_LANGUAGES = 256  # labels that are learned; more are an error
EPOCHS = 6


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, 0.5, out=x)
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def fold_table() -> np.ndarray:
    """Index of each byte's weights: capitals share those of small letters."""
    fold = np.arange(256)
    fold[0x41:0x5B] += 0x20
    fold[0x80:0x9F] += 0x20  # second byte of capitals such as those from U+00C0
    return fold


@dataclass
class ByteGru:
    """Weights of both directions, and of the layer that labels positions."""

    languages: list[str]
    inputs: np.ndarray  # (2, 256, 3 * hidden): one row per byte
    recurrent: np.ndarray  # (2, hidden, 3 * hidden): update, reset, candidate
    output: np.ndarray  # (2 * hidden + 1, languages), the last row being the bias

    @classmethod
    def new(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> ByteGru:
        draw = np.random.default_rng(seed)
        small = lambda *shape, s=0.3: (draw.standard_normal(shape) * s).astype(np.float32)
        inputs = small(2, 256, 3 * hidden)
        return cls(
            languages,
            inputs[:, fold_table()],
            small(2, hidden, 3 * hidden),
            small(2 * hidden + 1, len(languages)),
        )

    def run(self, steps: np.ndarray, way: int, keep: bool = False):
        """Hidden states (time, hidden, batch) of one direction; with what training needs.

        The batch is the last axis throughout, so that numpy's inner loops are long.
        """
        length, batch = steps.shape
        hidden = self.recurrent.shape[1]
        weights = np.ascontiguousarray(self.recurrent[way].T)
        table = np.ascontiguousarray(self.inputs[way].T)
        states = np.empty((length, hidden, batch), table.dtype)
        gates = np.empty((length, 3 * hidden, batch), table.dtype) if keep else None
        carried = np.empty((length, hidden, batch), table.dtype) if keep else None
        state = np.zeros((hidden, batch), table.dtype)
        from_state = np.empty((3 * hidden, batch), table.dtype)
        from_input = np.empty((3 * hidden, batch), table.dtype)
        for at in range(length) if way == 0 else range(length - 1, -1, -1):
            np.take(table, steps[at], axis=1, out=from_input, mode="clip")
            np.matmul(weights, state, out=from_state)
            both, candidate = from_input[: 2 * hidden], from_input[2 * hidden :]
            both += from_state[: 2 * hidden]
            _sigmoid(both)
            if keep:
                carried[at] = from_state[2 * hidden :]
            from_state[2 * hidden :] *= both[hidden:]
            candidate += from_state[2 * hidden :]
            np.tanh(candidate, out=candidate)
            if keep:
                gates[at] = from_input
            following = states[at]
            np.subtract(state, candidate, out=following)
            following *= both[:hidden]
            following += candidate
            state = following
        return (states, gates, carried) if keep else states

    def probabilities(self, steps: np.ndarray) -> np.ndarray:
        """Language probabilities (time, languages, batch) of each position."""
        hidden = self.recurrent.shape[1]
        logits = self.output[:hidden].T @ self.run(steps, 0)
        logits += self.output[hidden:-1].T @ self.run(steps, 1)
        logits += self.output[-1][:, None]
        return _softmax(logits)


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def gradients(net: ByteGru, steps: np.ndarray, target: np.ndarray, mask: np.ndarray):
    """Mean cross entropy over the positions in ``mask``, and its gradients."""
    hidden = net.recurrent.shape[1]
    length, batch = steps.shape
    passes = [net.run(steps, way, keep=True) for way in (0, 1)]
    joined = np.concatenate([passes[0][0], passes[1][0]], axis=1)
    slope = _softmax(net.output[:-1].T @ joined + net.output[-1][:, None])
    every = np.arange(batch)
    right = slope[:, target, every].copy()
    count = max(mask.sum(), 1)
    loss = -(np.log(right + 1e-9) * mask).sum() / count
    slope[:, target, every] = right - 1
    slope *= (mask / count)[:, None, :]
    d_output = np.zeros_like(net.output)
    d_output[:-1] = np.einsum("thb,tlb->hl", joined, slope, optimize=True)
    d_output[-1] = slope.sum(axis=(0, 2))
    d_joined = net.output[:-1] @ slope
    d_inputs, d_recurrent = np.zeros_like(net.inputs), np.zeros_like(net.recurrent)
    nothing = np.zeros((hidden, batch), net.output.dtype)
    one_hot = np.eye(256, dtype=net.output.dtype)
    for way in (0, 1):
        states, gates, carried = passes[way]
        weights = net.recurrent[way]
        back = nothing
        for at in range(length - 1, -1, -1) if way == 0 else range(length):
            before = at - 1 if way == 0 else at + 1
            state = states[before] if 0 <= before < length else nothing
            update, reset = gates[at, :hidden], gates[at, hidden : 2 * hidden]
            candidate = gates[at, 2 * hidden :]
            d = back + d_joined[at, way * hidden : (way + 1) * hidden]
            d_candidate = d * (1 - update) * (1 - candidate**2)
            d_update = d * (state - candidate) * update * (1 - update)
            d_reset = d_candidate * carried[at] * reset * (1 - reset)
            through = np.concatenate([d_update, d_reset, d_candidate * reset])
            d_recurrent[way] += state @ through.T
            back = d * update + weights @ through
            through[2 * hidden :] = d_candidate
            d_inputs[way] += (through @ one_hot[steps[at]]).T
    return loss, (d_inputs, d_recurrent, d_output)


def train(
    windows: np.ndarray, mask: np.ndarray, labels: np.ndarray, languages: list[str],
    epochs: int = EPOCHS, batch: int = 192, rate: float = 0.02, seed: int = 11,
) -> ByteGru:
    """A network fitted to windows (number, length) of known language."""
    net = ByteGru.new(languages)
    draw = np.random.default_rng(seed)
    fold = fold_table()
    windows = fold[windows]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in (net.inputs, net.recurrent, net.output)]
    step, total = 0, epochs * max(1, -(-len(windows) // batch))
    for _ in range(epochs):
        order = draw.permutation(len(windows))
        for start in range(0, len(order), batch):
            picked = order[start : start + batch]
            _, slopes = gradients(net, windows[picked].T, labels[picked], mask[picked].T)
            norm = np.sqrt(sum(float((s * s).sum()) for s in slopes))
            step += 1
            now = rate * (1 - 0.9 * step / total)
            for weight, slope, (mean, square) in zip((net.inputs, net.recurrent, net.output), slopes, moments):
                slope = slope * min(1.0, 1.0 / (norm + 1e-9))
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope * slope - square)
                weight -= now * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
    net.inputs = net.inputs[:, fold]
    return net


def cut_windows(texts: list[bytes], span: int = SPAN, context: int = CONTEXT):
    """Windows (time, number) over all texts, which positions count, and each window's text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    data = np.frombuffer(b"".join(texts) + b" ", np.uint8)
    per_text = -(-lengths // span)
    owner = np.repeat(np.arange(len(texts)), per_text)
    first = np.concatenate([[0], np.cumsum(per_text)])[:-1]
    begin = (np.arange(len(owner)) - first[owner]) * span  # first position labelled
    return data, starts, lengths, owner, begin


def fill_windows(cut, chosen: slice, span: int = SPAN, context: int = CONTEXT):
    data, starts, lengths, owner, begin = cut
    place = begin[chosen][None, :] + np.arange(-context, span + context)[:, None]
    length = lengths[owner[chosen]][None, :]
    inside = (place >= 0) & (place < length)
    steps = np.where(inside, data[np.where(inside, place + starts[owner[chosen]][None, :], 0)], 0x20)
    counted = inside.copy()
    counted[:context] = False
    counted[context + span :] = False
    return steps, counted


def classify(net: ByteGru, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and probability of each whole text; ``und`` and 0 where it has no letter."""
    known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if not known or not net.languages:
        return names, scores
    total = np.zeros((len(known), len(net.languages)))
    cut = cut_windows([texts[i].encode("utf-8", "replace") for i in known])
    owner = cut[3]
    for start in range(0, len(owner), WINDOWS):
        chosen = slice(start, start + WINDOWS)
        steps, counted = fill_windows(cut, chosen)
        labelled = net.probabilities(steps)[CONTEXT : CONTEXT + SPAN]
        labelled *= counted[CONTEXT : CONTEXT + SPAN, None, :]
        np.add.at(total, owner[chosen], labelled.sum(axis=0).T)
    total /= total.sum(axis=1, keepdims=True)
    best = total.argmax(axis=1)
    for row, i in enumerate(known):
        names[i], scores[i] = net.languages[best[row]], float(min(1.0, total[row, best[row]]))
    return names, scores


def fit(
    labelled: DataFrame, text: str = "text", language: str = "lang",
    per_language: int = TRAIN_PER_LANGUAGE,
) -> ByteGru:
    """A network fitted to at most ``per_language`` documents of each language.

    The documents are drawn by a hash of their text. Of each, up to three windows spread over the
    text are used. Rows without text or label do not count. Without any the network knows nothing. Of more
    than ``MAX_LANGUAGES`` languages the most frequent are learned, which bounds the sample.
    """
    size = SPAN + 2 * CONTEXT
    length = F.length(text)
    places = [F.lit(1), F.greatest(F.lit(1), F.floor(length / 2).cast("int")), F.greatest(F.lit(1), length - size)]
    name = F.col(language).cast("string")
    rows = labelled.where(F.col(text).isNotNull() & F.col(language).isNotNull() & (F.col(text) != "")).select(
        name.alias("_language"), row_hash(text).alias("_draw"), row_hash(*labelled.columns).alias("_row"),
        *[F.substring(text, p, F.lit(size)).alias(f"_w{k}") for k, p in enumerate(places)],
    )
    counts = rows.groupBy("_language").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "_language").limit(MAX_LANGUAGES).collect()
    # Of a frequent language a fraction by row hash is enough to choose from, and is dealt out
    # instead of all its rows. Eight times the sample makes fewer than wanted all but impossible.
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("_language") == row._language, min(1.0, 8 * per_language / row.n)).otherwise(share)
    position = F.pmod("_row", F.lit(1 << 30)) / F.lit(float(1 << 30))
    order = Window.partitionBy("_language").orderBy("_draw", "_row")
    picked = (
        rows.where(position < share)
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= per_language)
    )
    sample = picked.orderBy("_language", "_w0", "_w1", "_w2").collect()
    languages = sorted({r._language for r in sample})
    windows, masks, labels = [], [], []
    for row in sample:
        for piece in dict.fromkeys((row._w0, row._w1, row._w2)):
            data = np.frombuffer(piece.encode("utf-8", "replace")[:size], np.uint8)
            if len(data):
                windows.append(np.pad(data, (0, size - len(data)), constant_values=0x20))
                masks.append(np.arange(size) < len(data))
                labels.append(languages.index(row._language))
    if not windows:
        return ByteGru.new([])
    return train(np.array(windows), np.array(masks), np.array(labels), languages)


def identify(docs: DataFrame, net: ByteGru, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``lang_score`` of every whole text.

    A null text, one without a letter, and any text if nothing was learned get ``und`` and 0. All
    columns and rows stay, repeated ones too; a clashing name makes the new column's get an underscore.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Parcel(net))
    name, score = fresh(docs, "lang_pred", "lang_score")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())]
    )
    place = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                names, scores = classify(shared.value, batch.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[*batch.schema.names, name, score],
                )

    return docs.mapInArrow(run, schema)
