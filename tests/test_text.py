"""Edge values that the given tables do not contain."""

from __future__ import annotations

import sys
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from pairloom.functions import (
    as_text,
    clean_text,
    collapse_whitespace,
    falsy,
    has_visible_text,
    render_prompt,
    straighten_quotes,
)
from pairloom.functions.text import WHITESPACE


def expected(text: str | None) -> str:
    """The definition, in plain Python."""
    words = " ".join((text or "").split())
    return words.translate(str.maketrans("“”‘’", "\"\"''"))


EDGES = {
    "  a \t b ": "a b",
    "“Hi” ‘x’": "\"Hi\" 'x'",
    None: "",
    " \n": "",
    "": "",
    "a\u001cb": "a b",
    "a\u00a0b": "a b",
    "a\u3000\u2028b": "a b",
    "a\u200bb": "a\u200bb",
    "A": "A",
    "a": "a",
    "\u200b": "\u200b",
    "é e\u0301": "é e\u0301",
    "x\r\n\r\ny": "x y",
    "😀\u2003 😀": "😀 😀",
}


def cleaned(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select(
        "i",
        clean_text("t").alias("clean"),
        straighten_quotes(collapse_whitespace("t")).alias("in_steps"),
        clean_text(clean_text("t")).alias("twice"),
        has_visible_text("t").alias("visible"),
    ).collect()
    return [r for r in sorted(rows, key=lambda r: r.i)]


def test_clean_text_edges(spark):
    for (text, wanted), row in zip(EDGES.items(), cleaned(spark, EDGES)):
        assert row.clean == wanted == expected(text)
        assert row.twice == wanted
        assert row.visible == (wanted != "")
        assert row.in_steps == (None if text is None else wanted)


def test_whitespace_is_what_split_removes():
    every = (chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF)
    assert WHITESPACE == "".join(c for c in every if not c.split())


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.text(st.sampled_from(WHITESPACE + "“”‘’\"'ab  \u200b\u0000é😀"), max_size=12),
        min_size=20,
        max_size=60,
    )
)
def test_clean_text_on_random_text(spark, texts):
    for text, row in zip(texts, cleaned(spark, texts)):
        assert row.clean == row.twice == row.in_steps == expected(text)
        assert row.visible == (row.clean != "")


@pytest.mark.parametrize(
    "json", ["5", "0", "1.5", "true", "null", '{"x":1}', '["l"]', "[]"]
)
def test_type_guard_on_variants(spark, json):
    df = spark.range(1).select(F.parse_json(F.lit(json)).alias("v"))
    assert df.select(as_text("v", T.VariantType())).first()[0] == ""


def test_type_guard_keeps_strings(spark):
    df = spark.range(1).select(F.parse_json(F.lit('"5 ‘x’"')).alias("v"))
    assert df.select(as_text("v", T.VariantType())).first()[0] == "5 ‘x’"
    missing = spark.range(1).select(F.lit(None).cast("variant").alias("v"))
    assert missing.select(as_text("v", T.VariantType())).first()[0] == ""


FALSY_VALUES = [
    ("string", ["", " ", "a", None]),
    ("int", [0, 1, -1, None]),
    ("double", [0.0, -0.0, 0.5, float("nan"), None]),
    ("decimal(4,2)", [Decimal("0.00"), Decimal("0.01"), None]),
    ("boolean", [True, False, None]),
    ("array<int>", [[], [0], None]),
    ("map<string,int>", [{}, {"a": 0}, None]),
    ("binary", [b"", b"\0", None]),
]


@pytest.mark.parametrize("dtype,values", FALSY_VALUES)
def test_falsy_is_python_not(spark, dtype, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    got = df.select("i", falsy("v", df.schema["v"].dataType).alias("f")).orderBy("i").collect()
    assert [r.f for r in got] == [not v for v in values]


def test_prompt_of_missing_values(spark):
    df = spark.createDataFrame([("a", None), (None, "b")], "i string, r string")
    texts = [r[0] for r in df.select(render_prompt("i", "r")).collect()]
    assert texts[0].endswith("### Instruction:\na\n\n### Response:\nNone")
    assert texts[1].endswith("### Instruction:\nNone\n\n### Response:\nb")
    assert all(t.startswith("Below is an instruction that describes a task. Write") for t in texts)
