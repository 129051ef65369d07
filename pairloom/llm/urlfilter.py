"""URL filters by a cascade of Bloom filters, in column expressions only.

Listed keys are host and path prefix together, as in ``example.com/en/``. The keys of the corpus, every
host suffix with every path prefix that could be listed, are its key universe. The first filter holds the
listed keys; the second those of the universe that the first takes for listed by mistake; the third the
listed keys that the second takes for mistakes, and so on until nothing is mistaken. A key of the universe
is listed exactly if the number of filters that it passes before the first that it fails is odd. The first
filter is so sharp that its mistakes are fewer than the listed keys, and the others halve what is left, so
the whole cascade is in proportion to the list and not to the corpus. Filters are literals of column
expressions: the corpus is scanned, never joined or shuffled, to look keys up.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.common import fresh, ship, stored

ship(__name__)

MOST_LEVELS = 64


@dataclass(frozen=True)
class UrlRule:
    """Applies to ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host.lower() + self.path


def host_of(url: Column) -> Column:
    """What stands between ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """All keys that could be listed for a URL: longest first, then the longer host first."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.left(path, F.lit(n))) for n in sorted(lengths, reverse=True)]),
        lambda p: p.isNotNull(),
    )
    both = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    # Stable by construction: suffixes run from long to short, and the sort is by length only.
    placed = F.transform(both, lambda k, i: F.struct((-F.length(k)).alias("n"), i.alias("i"), k.alias("k")))
    return F.transform(F.sort_array(placed), lambda x: x["k"])


@dataclass(frozen=True)
class Filter:
    """A Bloom filter: ``hashes`` positions per key in an array of 64-bit words."""

    level: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def holds(self, key: Column) -> Column:
        array = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        found = None
        for position in _positions(key, self.level, self.bits, self.hashes):
            word = F.get(array, F.shiftright(position, 6).cast("int"))
            bit = F.expr("1L") == F.call_function("getbit", word, F.pmod(position, F.lit(64)).cast("int")).cast("long")
            found = bit if found is None else found & bit
        return found


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(k)), F.lit(bits)) for k in range(hashes)]


def build_filter(keys: DataFrame, key: str, n: int, share: float, level: int) -> Filter:
    """A filter of ``n`` keys that takes a share of other keys for held; sized by ``n`` alone."""
    hashes = max(1, round(math.log2(1 / share)))
    bits = max(64, math.ceil(n * hashes / math.log(2)))
    at = F.explode(F.array(*_positions(F.col(key), level, bits, hashes)))
    one = F.lit(1).cast("long")
    word = F.bit_or(F.call_function("shiftleft", one, F.pmod("_at", F.lit(64)).cast("int")))
    rows = keys.select(at.alias("_at")).groupBy(F.shiftright("_at", 6).alias("_w")).agg(word.alias("_bits"))
    words = [0] * (-(-bits // 64))
    for row in rows.collect():  # as many rows as the filter has words
        words[row._w] = row._bits
    return Filter(level, bits, hashes, tuple(words))


@dataclass(frozen=True)
class Cascade:
    """Exact membership for the keys of the universe it was built over."""

    filters: tuple[Filter, ...]

    def lists(self, key: Column) -> Column:
        answer = F.lit(len(self.filters) % 2 == 1)
        for k in reversed(range(len(self.filters))):
            answer = F.when(self.filters[k].holds(key), answer).otherwise(F.lit(k % 2 == 1))
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame, key: str = "key") -> Cascade:
    """A cascade for ``listed`` keys over a universe, which may hold keys more than once.

    The universe is scanned twice: to estimate how many keys it has, and for the first filter's
    mistakes. Nulls are no keys. An empty list gives a cascade that lists nothing.
    """
    right = stored(listed.where(F.col(key).isNotNull()).select(key).distinct(), "listed")
    n = right.count()
    if not n:
        return Cascade(())
    size = universe.agg(F.approx_count_distinct(key).alias("n")).head().n
    share = min(0.5, n / (math.sqrt(2) * max(size, 1)))
    filters = [build_filter(right, key, n, share, 0)]
    wrong = universe.where(F.col(key).isNotNull() & filters[0].holds(F.col(key))).select(key).distinct()
    wrong = stored(wrong.join(right, key, "left_anti"), "mistaken")
    # Each filter holds what the one before mistook; the other side is what it is held against.
    held, other = wrong, right
    while n := held.count():
        if len(filters) == MOST_LEVELS:
            raise RuntimeError("keys that hash alike at every level")
        filters.append(build_filter(held, key, n, 0.5, len(filters)))
        mistaken = stored(other.where(filters[-1].holds(F.col(key))), "mistaken")
        held, other = mistaken, held
    return Cascade(tuple(filters))


def judge(
    pages: DataFrame, rules: Sequence[UrlRule], otherwise: str = "allow", url: str = "url"
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict``: those of the longest rule that fits.

    Where no rule fits, ``rule`` is null and the verdict ``otherwise``; so it is for a null URL and
    one without ``://``, whose host and path are empty. Of two rules with the same key the later
    counts. Rows and columns stay; clashing names get an underscore.
    """
    names = dict(zip(("host", "path", "rule", "verdict"), fresh(pages, "host", "path", "rule", "verdict")))
    (candidates,) = fresh(pages, "_keys")
    spark = pages.sparkSession
    verdict_of = {rule.key: rule.verdict for rule in rules}
    lengths = {len(rule.path) for rule in rules} or {0}
    split = pages.withColumn(names["host"], host_of(F.col(url))).withColumn(names["path"], path_of(F.col(url)))
    keyed = split.withColumn(candidates, keys_of(F.col(names["host"]), F.col(names["path"]), lengths))
    universe = keyed.select(F.explode(candidates).alias("key"))
    fits = F.lit(False)
    cascades = {}
    for verdict in sorted(set(verdict_of.values())):
        keys = [k for k, v in verdict_of.items() if v == verdict]
        listed = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(keys)), "array<string>")).alias("key"))
        cascades[verdict] = build_cascade(listed, universe)
    lists = lambda k: [(v, c.lists(k)) for v, c in cascades.items()]

    def any_lists(k: Column) -> Column:
        found = fits
        for _, member in lists(k):
            found = found | member
        return found

    rule = F.get(F.filter(F.col(candidates), any_lists), F.lit(0))
    ruled = keyed.withColumn(names["rule"], rule)
    verdict = F.when(F.col(names["rule"]).isNull(), F.lit(otherwise))
    for name, member in lists(F.col(names["rule"])):
        verdict = verdict.when(member, F.lit(name))
    return ruled.withColumn(names["verdict"], verdict).drop(candidates)


# --- Fixed values: the rules of the registered query ---------------------------------------------
RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)
# -------------------------------------------------------------------------------------------------


def verdicts(pages: DataFrame) -> DataFrame:
    judged = judge(pages.select("page_id", "url"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM p),
u AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(rhost, rpath, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT page_id, max_by(rhost || rpath, length(rhost || rpath) * 1000 + length(rhost)) AS rule,
    max_by(v, length(rhost || rpath) * 1000 + length(rhost)) AS v
  FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN best USING (page_id)
"""
