"""Quality rules as a short-circuit cascade, in column expressions only.

Each rule is a column that is true for texts to reject. Rules differ in what they cost and in how many
texts they reject, so both are estimated on a bounded sample, and the rules are asked in order of
rejections per second. A text that one rule rejects is not shown to the rest. The order changes the
time, never the verdict: a text is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.common import SPACES, fresh, row_hash

SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 1024


@dataclass(frozen=True)
class Rule:
    """``reject`` is true for a text to drop; null counts as false."""

    name: str
    reject: Column


@dataclass(frozen=True)
class Measured:
    """What the sample says of a rule: seconds for it and the share of rows it rejects."""

    rule: Rule
    seconds: float
    rejected: float


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Runs of characters other than white space (space, tab to carriage return), in order."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed != "", F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(
        F.array().cast("array<string>")
    )


def count_symbols(text: Column, symbols: str = SYMBOLS) -> Column:
    return F.length(text) - F.length(F.translate(text, symbols, ""))


def count_repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return let(lines, lambda l: F.size(l) - F.size(F.array_distinct(l)))


def count_repeated_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words found twice or more, the first time included.

    Windows are told apart by a 64-bit hash of their words. Most texts have no two equal windows,
    which their number of distinct hashes shows. In the others hashes are sorted together with their
    places, equal neighbours give the places of repeated windows, and a window adds the words that
    the repeated window before it does not reach.
    """

    def windows(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - width)
        return F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            same = lambda x, k: F.get(s, k)["h"].eqNullSafe(x["h"])
            kept = F.filter(s, lambda x, k: same(x, k + 1) | same(x, k - 1))
            return F.sort_array(F.transform(kept, lambda x: x["i"]))

        def reach(p: Column) -> Column:
            added = F.transform(
                p, lambda x, k: F.least(F.lit(width), F.coalesce(x - F.get(p, k - 1), F.lit(width)))
            )
            return F.aggregate(added, F.lit(0), lambda total, x: total + x)

        return let(let(placed, repeated), reach)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(covered(hashes))

    return let(
        words, lambda w: F.when(F.size(w) < width, 0).otherwise(let(windows(w), count))
    )


def measure(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """Adds the counts that rules are made of; also says how each column is called.

    ``n_words``, ``word_chars`` (characters in words), ``n_symbols``, ``n_dup_lines`` and
    ``n_repeat_words``, all long; a null text counts as empty. A clashing name gets an underscore.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    called = dict(zip(names, fresh(docs, *names)))
    words, plain = fresh(docs, "_words", "_plain")
    prepared = docs.withColumn(plain, F.coalesce(F.col(text), F.lit(""))).withColumn(
        words, words_of(F.col(plain))
    )
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": count_symbols(F.col(plain)),
        "n_dup_lines": count_repeated_lines(F.col(plain)),
        "n_repeat_words": count_repeated_words(F.col(words)),
    }
    return prepared.select(
        *docs.columns, *[c.cast("long").alias(called[n]) for n, c in counts.items()]
    ), called


def draw(docs: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows, by a hash of their values; the share is chosen so that few more are read."""
    kept = [c for c, kind in docs.dtypes if "map" not in kind and "variant" not in kind]
    share = min(1.0, 2 * rows / max(docs.count(), 1))
    return docs.where(F.pmod(row_hash(*kept), F.lit(1 << 30)) < int(share * (1 << 30))).limit(rows)


def estimate(docs: DataFrame, rules: Sequence[Rule], rows: int = SAMPLE_ROWS) -> list[Measured]:
    """Times every rule on at most ``rows`` rows, drawn by a hash of their values."""
    drawn = draw(docs, rows).persist()
    try:
        n = drawn.count()
        found = []
        for rule in rules:
            rejecting = drawn.agg(F.count_if(F.coalesce(rule.reject, F.lit(False))).alias("n"))
            rejecting.collect()  # compiles the expression, so that the next run shows its cost
            start = time.perf_counter()
            rejected = rejecting.head().n
            found.append(Measured(rule, time.perf_counter() - start, rejected / max(n, 1)))
        return found
    finally:
        drawn.unpersist()


def by_rejection_per_cost(measured: Sequence[Measured]) -> list[Rule]:
    order = sorted(measured, key=lambda m: -m.rejected / max(m.seconds, 1e-6))
    return [m.rule for m in order]


def rejected(rules: Sequence[Rule]) -> Column:
    """True where a rule rejects; later rules are not evaluated for what an earlier one rejects."""
    verdict = F.lit(False)
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.reject, F.lit(False)), F.lit(True)).otherwise(verdict)
    return verdict


def cascade(
    docs: DataFrame, rules: Sequence[Rule], sample: DataFrame | None = None, name: str = "kept"
) -> DataFrame:
    """Adds ``kept``: false where any rule rejects. Asks the rules in order of rejection per cost.

    ``sample`` is what costs are estimated on, by default the table itself; an empty one leaves
    the order as given. Rows, nulls and repeated rows stay; a clashing name gets an underscore.
    """
    (kept,) = fresh(docs, name)
    ordered = by_rejection_per_cost(estimate(docs if sample is None else sample, rules))
    return docs.withColumn(kept, ~rejected(ordered))


def rules_for_prose(text: Column, called: dict[str, str]) -> list[Rule]:
    """Rules on the counts of ``measure``, loose enough to keep clean text in any language."""
    n = {name: F.col(column) for name, column in called.items()}
    lines = F.size(F.split(text, "\n"))
    return [
        Rule("few words", n["n_words"] < 50),
        Rule("repeated words", 100 * n["n_repeat_words"] > 50 * n["n_words"]),
        Rule("symbols", 100 * n["n_symbols"] > 30 * n["n_words"]),
        Rule("repeated lines", 100 * n["n_dup_lines"] > 30 * lines),
        Rule("very short or long words", (n["word_chars"] < 2 * n["n_words"]) | (n["word_chars"] > 15 * n["n_words"])),
        Rule("capitals only", (F.upper(text) == text) & (F.lower(text) != text)),
    ]


def verdicts(docs: DataFrame) -> DataFrame:
    """The counts of every document, whether it fails the base rules, and whether it is kept."""
    counted, called = measure(docs.select("doc_id", "text"))
    sample, _ = measure(draw(docs.select("doc_id", "text"), SAMPLE_ROWS))
    rules = rules_for_prose(F.coalesce("text", F.lit("")), called)
    base, others = rules[:2], rules[2:]
    failed = rejected(base)
    ordered = by_rejection_per_cost(estimate(sample, others))
    return counted.select(
        "doc_id",
        *called.values(),
        failed.alias("base_failed"),
        (~rejected([*base, *ordered])).alias("kept"),
    )


# The same results in DuckDB.
ORACLE_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM docs),
m AS (
  SELECT *, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    list_transform(range(1, len(words) - 1), lambda i: [words[i], words[i + 1], words[i + 2]]) AS windows
  FROM w),
places AS (SELECT doc_id, unnest(windows) AS win, unnest(range(len(windows))) AS i FROM m),
twice AS (SELECT doc_id, win FROM places GROUP BY ALL HAVING count(*) > 1),
hit AS (SELECT p.doc_id, p.i FROM places p JOIN twice t USING (doc_id, win)),
covered AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS k FROM hit) GROUP BY doc_id),
c AS (SELECT m.*, coalesce(n, 0) AS n_repeat_words FROM m LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 30 * n_words
    OR 100 * n_dup_lines > 30 * len(string_split(text, chr(10)))
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR (upper(text) = text AND lower(text) <> text)) AS kept
FROM c
"""
