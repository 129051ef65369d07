"""Toxicity by weak supervision.

Many voters look at a text. Lexicon voters stand for one word or word beginning each, chosen from a
bounded sample of labelled documents so that together they cover the toxic ones; count voters ask how
many such words a text has; pattern voters look at shouting and exclamation marks; the annotators' labels
are one more voter, and no more than that. A generative model of the votes, with a table of vote
probabilities per class and voter, is fitted by expectation maximisation: it estimates how accurate each
voter is, and from what is left of the votes' covariance given the class, which voters repeat each other;
correlated voters share their say. Its posterior labels train a linear classifier on counts of terms
and on the patterns, and only that classifier scores documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pairloom.llm.common import Parcel, fresh, ship, stored

ship(__name__)

THRESHOLD = 0.3
SAMPLE_PER_LABEL = 4000  # labelled documents per label that are learned from
PREFIXES = range(3, 9)  # lengths of word beginnings that may become terms
CANDIDATES = 1500  # terms kept by the strength of their tie to the label
FEATURES = 500  # of these, terms that the classifier weighs
LEXICON_VOTERS = 48
LEAST_Z = 3.0
ANNOTATORS = 0.98  # taken for the accuracy of the labels
PER_WORDS = 100  # frequencies are per so many words
CACHE_WORDS = 400_000


def terms_of(word: str) -> list[str]:
    """The word itself, marked by a final ``$``, and its beginnings."""
    start, end = 0, len(word)
    while start < end and not word[start].isalnum():
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    bare = word[start:end]
    if not bare:
        return []
    return [bare[:n] for n in PREFIXES if len(bare) >= n] + [bare + "$"]


class Lexicon(dict):
    """Numbers of a word's terms among the chosen ones; filled as words are met."""

    def __init__(self, terms: list[str]):
        super().__init__()
        self.number = {t: i for i, t in enumerate(terms)}

    def __reduce__(self):
        return Lexicon, (list(self.number),)

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > CACHE_WORDS:
            self.clear()
        number = self.number
        found = self[word] = tuple(number[t] for t in terms_of(word) if t in number)
        return found


def look(lexicon: Lexicon, text: str | None) -> tuple[Counter, list[float], int]:
    """Counts of terms in a whole text, its patterns, and its number of words."""
    text = text or ""
    words = text.lower().split()
    counts = Counter()
    matched = 0
    for found in map(lexicon.__getitem__, words):
        if found:
            matched += 1
            counts.update(found)
    n = max(len(words), 1)
    return counts, [
        1.0 if text.isupper() else 0.0,
        min(1.0, text.count("!") / n),
        math.log1p(matched) / math.log1p(n),
    ], n


@dataclass
class LabelModel:
    """What a vote of each voter for or against is worth, in log odds, and the voter's say."""

    gain: np.ndarray  # (voters, 2): of a vote against, of one for
    say: np.ndarray
    prior: float
    correlation: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of the toxic class; who abstains says nothing."""
        odds = (votes > 0) @ (self.gain[:, 1] * self.say) + (votes < 0) @ (self.gain[:, 0] * self.say)
        odds = odds + math.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit_label_model(
    votes: np.ndarray, start: np.ndarray, prior: float, annotators: tuple[int, ...] = (0,), rounds: int = 30
) -> LabelModel:
    """Expectation maximisation from a first guess at the posterior; the class balance is given.

    ``votes`` is -1, 0 (abstains) or 1. Each round estimates how often a voter casts either vote in
    either class, which is its accuracy. Every tenth round the correlations of votes within the classes
    are estimated anew; a voter's log odds count ``1 / (1 + sum of its positive correlations)``. The
    accuracy of ``annotators`` is given, which holds the classes in place, and they repeat nobody.
    """
    n, m = votes.shape
    posterior, say, correlation = start.astype(float), np.ones(m), np.eye(m)
    prior = float(np.clip(prior, 1e-3, 1 - 1e-3))
    given = list(annotators)
    for turn in range(rounds):
        classes = np.stack([1 - posterior, posterior])
        size = classes.sum(axis=1)[:, None] + 1.0
        against, for_ = ((classes @ (votes == v) + 0.5) / size for v in (-1, 1))
        gain = np.log(np.stack([against[1] / against[0], for_[1] / for_[0]], axis=1))
        gain[given] = np.log(ANNOTATORS / (1 - ANNOTATORS)) * np.array([-1.0, 1.0])
        if turn % 10 == 9:
            # Covariance of the votes within the classes.
            covariance = np.zeros((m, m))
            for weight in (posterior, 1 - posterior):
                left = votes - (weight @ votes) / max(weight.sum(), 1e-9)
                covariance += (left * weight[:, None]).T @ left / n
            deviation = np.sqrt(np.diag(covariance)) + 1e-6
            correlation = covariance / np.outer(deviation, deviation)
            others = np.clip(correlation - np.eye(m), 0, 1)
            others[others < 0.1] = 0.0
            others[given] = others[:, given] = 0.0
            say = 1 / (1 + others.sum(axis=1))
        model = LabelModel(gain, say, prior, correlation)
        posterior = model.posterior(votes)
    return model


@dataclass
class Classifier:
    """Weights of terms' counts, of their frequencies, of patterns and of nothing, in this order."""

    lexicon: Lexicon
    weights: np.ndarray

    def score(self, text: str | None) -> float:
        counts, patterns, n = look(self.lexicon, text)
        weights, terms = self.weights, len(self.lexicon.number)
        odds = weights[-1] + float(weights[-1 - len(patterns) : -1] @ patterns)
        for term, count in counts.items():
            odds += weights[term] * math.log1p(count) + weights[terms + term] * math.log1p(PER_WORDS * count / n)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))


def fit_linear(x: np.ndarray, target: np.ndarray, penalty: float = 1e-4, steps: int = 400) -> np.ndarray:
    """Logistic regression on soft labels: full batches, Adam, quadratic penalty."""
    weights = np.zeros(x.shape[1], np.float64)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        guess = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        slope = x.T @ (guess - target) / len(x)
        slope[:-1] += penalty * weights[:-1]
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        rate = 0.1 * (1 - step / (steps + 1))
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return weights


def choose_voters(has: np.ndarray, label: np.ndarray, strength: np.ndarray, most: int) -> list[int]:
    """Terms that cover the toxic documents: each time the one that adds most for its mistakes."""
    open_ = label == 1
    wrong = has[label == 0].sum(axis=0)
    chosen: list[int] = []
    while len(chosen) < min(most, len(strength)) and open_.any():
        gain = has[open_].sum(axis=0) / (1.0 + wrong)
        gain[chosen] = 0
        best = int(np.lexsort((strength, gain))[-1])
        if gain[best] <= 0:
            break
        chosen.append(best)
        open_ &= ~has[:, best]
    return chosen


def count_terms(sample: DataFrame, text: str, label: str, most: int = CANDIDATES) -> list[tuple[str, float]]:
    """Terms tied to label 1, strongest first, with the z-score of their log odds ratio."""
    n = {row[label]: row.n for row in sample.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (Counter(), Counter())
            for words, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[toxic].update({t for w in set(words.lower().split()) for t in terms_of(w)})
            terms = list(found[0].keys() | found[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([found[1][t] for t in terms], pa.int64()), pa.array([found[0][t] for t in terms], pa.int64())],
                names=["term", "toxic", "clean"],
            )

    rows = sample.select(text, label).mapInArrow(count, "term string, toxic long, clean long")
    a, b = F.col("toxic"), F.col("clean")
    odds = F.log((a + 0.5) / (n1 - a + 0.5)) - F.log((b + 0.5) / (n0 - b + 0.5))
    z = odds / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    kept = (
        rows.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where("toxic >= 2").select("term", z.alias("z")).where(F.col("z") > LEAST_Z)
        .orderBy(F.desc("z"), "term").limit(most)
    )
    return [(r.term, r.z) for r in kept.collect()]


def draw_sample(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, per_label: int
) -> DataFrame:
    """``text, label`` of at most ``per_label`` documents of either label, drawn by a hash of the id.

    The ids are drawn first, so that texts are neither shuffled nor sorted: a bounded table of ids
    is broadcast to the documents. Of several documents with one id the least text is taken.
    """
    drawn = None
    for value in (0, 1):
        of_label = labels.where(F.col(label) == value).select(F.col(doc_id).alias("_id"), F.lit(value).alias("label"))
        some = of_label.orderBy(F.xxhash64("_id"), "_id").limit(per_label)
        drawn = some if drawn is None else drawn.unionByName(some)
    drawn = stored(drawn, "drawn-ids")
    found = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(drawn), "_id")
    return stored(found.groupBy("_id", "label").agg(F.min("text").alias("text")).select("text", "label"), "labelled")


def one_label(labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """One row per id with a label of 0 or 1; of several labels of an id the highest counts."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    return known.groupBy(doc_id).agg(F.max(label).cast("int").alias(label))


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    per_label: int = SAMPLE_PER_LABEL,
) -> Classifier:
    """A classifier learned from documents that have a label of 0 or 1 in the table of labels.

    Labels that are something else, null, or of no document are not learned from. Without toxic or
    without clean examples every text scores the share of toxic labels.
    """
    known = one_label(labels, doc_id, label)
    overall = {r[label]: r.n for r in known.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = overall.get(1, 0), overall.get(0, 0)
    base = (n1 + 0.5) / (n1 + n0 + 1.0) if n1 + n0 else 0.01
    base_odds = math.log(base / (1 - base))
    nothing = Classifier(Lexicon([]), np.array([0.0, 0.0, 0.0, base_odds]))
    if not n1 or not n0:
        return nothing
    sample = draw_sample(docs, known, doc_id, text, label, per_label)
    if sample.select("label").distinct().count() < 2:
        return nothing
    terms = count_terms(sample, "text", "label")
    lexicon = Lexicon([t for t, _ in terms])

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [look(lexicon, t) for t in batch.column(0).to_pylist()]  # whole texts
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array([list(c) for c, _, _ in seen], pa.list_(pa.int32())),
                    pa.array([list(c.values()) for c, _, _ in seen], pa.list_(pa.int32())),
                    pa.array([p for _, p, _ in seen], pa.list_(pa.float64())),
                    pa.array([n for _, _, n in seen], pa.int64()),
                ],
                names=["label", "terms", "counts", "patterns", "words"],
            )

    schema = "label int, terms array<int>, counts array<int>, patterns array<double>, words long"
    seen = sample.mapInArrow(describe, schema).toArrow()  # at most twice per_label short rows
    label_of = seen["label"].to_numpy().astype(int)
    patterns = np.array(seen["patterns"].to_pylist(), float).reshape(len(label_of), -1)
    lists = seen["terms"].combine_chunks()
    row = np.repeat(np.arange(len(label_of)), np.diff(lists.offsets.to_numpy()))
    flat = lists.flatten().to_numpy()
    counts = np.zeros((len(label_of), len(terms)), np.float32)
    counts[row, flat] = seen["counts"].combine_chunks().flatten().to_numpy()

    strength = np.array([z for _, z in terms])
    voters = choose_voters(counts > 0, label_of, strength, LEXICON_VOTERS)
    named = counts[:, voters]
    hits = (named > 0).sum(axis=1) if voters else np.zeros(len(label_of))
    total = named.sum(axis=1) if voters else np.zeros(len(label_of))
    # A lexicon that finds nothing says nothing: it does not know every language.
    vote = lambda yes, no=False: np.where(yes, 1, np.where(no, -1, 0))
    columns = [
        vote(label_of == 1, label_of == 0),
        *[vote(named[:, k] > 0) for k in range(len(voters))],
        vote(total >= 2),
        vote(total >= 4),
        vote(hits >= 2),
        vote(patterns[:, 0] > 0),
        vote(patterns[:, 1] > 0.2),
    ]
    votes = np.stack(columns, axis=1)
    share = label_of.mean()
    model = fit_label_model(votes, np.where(label_of == 1, 0.95, 0.02), share)
    posterior = model.posterior(votes)

    used = counts[:, :FEATURES]
    often = np.log1p(PER_WORDS * used / seen["words"].to_numpy()[:, None])
    x = np.concatenate([np.log1p(used), often, patterns, np.ones((len(label_of), 1))], axis=1).astype(np.float32)
    weights = fit_linear(x, posterior)
    # The sample has more toxic documents than there are; the odds go back to the true share.
    weights[-1] += base_odds - math.log(share / (1 - share))
    return Classifier(Lexicon([t for t, _ in terms[:FEATURES]]), weights)


def score(docs: DataFrame, model: Classifier, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``toxicity``, from 0 to 1, and ``toxic_predicted`` of every whole text.

    Null and empty texts have no terms and score low. Rows and columns stay, repeated rows too; a
    clashing name makes the new column's get an underscore.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Parcel(model))
    value, predicted = fresh(docs, "toxicity", "toxic_predicted")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(value, T.DoubleType()), T.StructField(predicted, T.IntegerType())]
    )
    place = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                scores = [shared.value.score(t) for t in batch.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                    names=[*batch.schema.names, value, predicted],
                )

    return docs.mapInArrow(run, schema)

