"""URL filters, quality rules and mixing on rows made to be awkward, against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairloom.llm import mixing, quality, urlfilter
from pairloom.llm.urlfilter import UrlRule

SPACES = re.compile("[^\x20\x09-\x0d]+")


def judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.key), len(r.host)), default=None)
    return host, path, best.key if best else None, best.verdict if best else "allow"


def test_urls(spark):
    rules = [*urlfilter.RULES, UrlRule("a.net", "/es/", "allow"), UrlRule("org", "", "block")]
    draw = random.Random(3)
    hosts = ["com", "xcom", "example.com", "WWW.Example.com", "b.a.net", "net", "x..org", "é.org", ""]
    tails = ["", "/", "/en/", "/en", "/es/1?x=/fr/", "/fr/#a", "?q=1", "#://b.com/", "/en/" + "x" * 3000]
    urls = [f"http://{draw.choice(hosts)}{draw.choice(tails)}" for _ in range(300)]
    urls += [None, "", "no scheme", "://com/", "a://b://com/", "http://com\n/"]
    rows = [(i, u, "mine") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows + rows[:3], "page_id long, url string, rule string")
    found = urlfilter.judge(pages, rules)
    assert found.columns == ["page_id", "url", "rule", "host", "path", "rule_", "verdict"]
    got = Counter(tuple(r) for r in found.select("page_id", "host", "path", "rule_", "verdict").collect())
    assert got == Counter((i, *judge(u, rules)) for i, u, _ in rows + rows[:3])
    assert urlfilter.judge(pages.limit(0), rules).count() == 0
    assert urlfilter.judge(pages, []).where("verdict <> 'allow' OR rule_ IS NOT NULL").count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("key LIKE '%7' OR key LIKE 'k1%'").unionByName(spark.createDataFrame([("elsewhere",), (None,)], "key string"))
    cascade = urlfilter.build_cascade(listed, universe)
    assert len(cascade.filters) > 2
    wrong = universe.where(cascade.lists(F.col("key")) != F.expr("key LIKE '%7' OR key LIKE 'k1%'"))
    assert wrong.count() == 0


def counts(text):
    text = text or ""
    words = SPACES.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if SPACES.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def test_quality_counts(spark):
    draw = random.Random(4)
    texts = [None, "", " \n\t", "a", "a a a a", "a b c a b c", "x\n\n x\nx\nx ", "é​#$ \u00a0|", "#" * 10]
    texts += ["".join(draw.choice("ab#é \n\t\r\x0b") for _ in range(draw.randint(0, 120))) for _ in range(400)]
    texts += [" ".join(draw.choice(["the", "of", "and", "x"]) for _ in range(3000))]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    measured, called = quality.measure(docs)
    assert called["n_words"] == "n_words_"
    columns = [called[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    got = {r[0]: tuple(r[1:]) for r in measured.select("doc_id", *columns).collect()}
    assert got == {i: counts(t) for i, t in enumerate(texts)}


def test_cascade_asks_by_rejections_per_cost(spark):
    first, second = quality.Rule("a", F.lit(True)), quality.Rule("b", F.lit(True))
    measured = [quality.Measured(first, 2.0, 0.5), quality.Measured(second, 0.1, 0.2)]
    assert [r.name for r in quality.by_rejection_per_cost(measured)] == ["b", "a"]
    docs = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "doc_id long, kept string")
    out = quality.cascade(docs, [quality.Rule("null", F.col("kept").isNull()), quality.Rule("none", F.lit(None).cast("boolean"))])
    assert sorted((r.doc_id, r.kept_) for r in out.collect()) == [(1, True), (2, False), (2, False)]
    assert quality.cascade(docs.limit(0), [quality.Rule("null", F.col("kept").isNull())]).count() == 0


def fill(sizes, weights, most=3):
    """Sets what is above its limit, one source at a time, and shares the rest again."""
    fixed, target = {}, {}
    while True:
        left = sum(sizes.values()) - sum(fixed.values())
        free = {s: weights[s] for s in sizes if s not in fixed}
        target = {s: w * left / sum(free.values()) for s, w in free.items()} if free else {}
        over = {s: most * sizes[s] for s in target if target[s] > most * sizes[s]}
        if not over:
            return {**target, **fixed}
        fixed.update(over)


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, seed):
    draw = random.Random(seed)
    sources = [None, "", "a", "b", "é", "z", "😀", "\uffff"]
    rows = []
    for i in range(800):
        source = "a" if draw.random() < 0.4 else draw.choice(sources)
        n = draw.choice([0, 1, 3, 10, 60]) if source != "b" else draw.choice([0, 1])
        rows.append((i, " ".join(["w"] * n) if n else draw.choice([None, "", " "]), source, "extra"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    found = mixing.report(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes = {s: sum(len((t or "").split()) for _, t, x, _ in rows if x == s) for s in {r[2] for r in rows}}
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    target = fill(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    assert len(found) == len(rows)
    taken = Counter()
    for r in found:
        taken[r.source] += r.taken
        assert r.taken <= 3 * r["size"] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 30.5, s
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.report(docs.repartition(5)).join(docs.select("doc_id", "source"), "doc_id").collect()))


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.report(docs).count() == 0
    empty = spark.createDataFrame([(1, None, None), (1, None, None), (None, "", "a")], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.report(empty).collect()] == [0, 0, 0]


def words_at(tilt, mean, sizes):
    return sum(n * min(3.0, math.exp(min(50.0, tilt * z / mean))) * z for z, n in sizes)


def test_tilts_solve_the_dual(spark):
    """The multipliers against bisection, from targets near nothing to near three times the source."""
    draw, rows, targets = random.Random(8), [], {}
    for k, share in enumerate((1e-6, 0.2, 0.999, 1.0, 1.7, 2.9, 2.999999, 3.0)):
        sizes = {z: draw.randrange(1, 50) for z in (0, 1, 5, 40, 300, 20_000)}
        rows += [(f"s{k}", z, n) for z, n in sizes.items()]
        targets[f"s{k}"] = (sum(z * n for z, n in sizes.items()), share, [(z, n) for z, n in sizes.items() if z])
    frame = spark.createDataFrame(rows, "source string, size long, n long")
    sources = spark.createDataFrame([(s, total, total * share) for s, (total, share, _) in targets.items()] + [(None, 0, 0.0)], "source string, source_size long, target double")
    for r in mixing.tilts(frame, sources).collect():
        if r.source is None or targets[r.source][1] == 3.0:
            assert r.tilt is None
            continue
        total, share, sizes = targets[r.source]
        assert r.mean == pytest.approx(total / sum(n for _, n in sizes))
        assert words_at(r.tilt, r.mean, sizes) == pytest.approx(total * share, rel=1e-9)
    with pytest.raises(ArithmeticError):
        mixing.tilts(frame, sources, steps=1)


def test_rates_differ_by_size_and_come_to_the_target(spark):
    draw = random.Random(5)
    rows = [(k, "w " * draw.choice([1, 2, 7, 30, 200, 900]), draw.choice("aabcde"), k % 3) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _words int")
    found = mixing.mix(docs).collect()
    for source in "abcde":
        own = [r for r in found if r.source == source]
        rate = {r["size"]: r.rate for r in own}
        assert sum(r.rate * r["size"] for r in own) == pytest.approx(own[0].target)
        if own[0].target < 2.9 * own[0].source_size:
            # An exponential tilt: the logarithm of the rate is in proportion to the size.
            free = [(z, math.log(x)) for z, x in rate.items() if x < 3]
            assert len(free) > 2 and len({round(x / z, 9) for z, x in free}) == 1
            assert own[0].target == pytest.approx(own[0].source_size) or len(set(rate.values())) > 2
        assert abs(sum(r.copies * r["size"] for r in own) - own[0].target) <= 450
        assert all(abs(r.copies - r.rate) < 1 for r in own)
    taken = mixing.apply_mix(docs)
    assert taken.columns == docs.columns
    counts = Counter(r.doc_id for r in taken.collect())
    assert counts == {r.doc_id: r.copies for r in found if r.copies}
    assert {(r.doc_id, r._words) for r in taken.collect()} <= {(k, w) for k, _, _, w in rows}


def test_one_size_and_repeated_rows(spark):
    """All documents alike but for their ids, and a third of all rows the same."""
    rows = [(k if k % 3 else 7, "one two three", "ab"[k % 2]) for k in range(900)]
    found = mixing.report(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(found) == 900 and all(r.taken in (0, 3, 6, 9) for r in found)
    assert len({r.taken for r in found if r.doc_id == 7}) <= 2
