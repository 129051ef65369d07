from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from pairloom.operators import (
    clean_pairs,
    project,
    resolve_aliases,
    resolve_pair,
    tag,
    union_ordered,
)

CASES = [
    ("question string, answer string", ("q1", "a1"), ("q1", "a1")),
    ("instruction string, response string", ("i1", "r1"), ("i1", "r1")),
    ("answer string, question string", ("a1", "q1"), ("q1", "a1")),
    (
        "id string, question string, answer string, instruction string",
        ("x", None, "a1", "i1"),
        ("x", None),
    ),
    ("id string, question string, answer string", ("x", "q1", ""), ("x", "q1")),
    ("question string, answer string", (" ", "a1"), (" ", "a1")),
    ("title string, body string", ("t", "b"), ("t", "b")),
    ("title string", ("t",), ("t", "")),
    ("id int, text string", (7, "b"), ("", "b")),
    ("id string, question int, answer string", ("x", 0, "a1"), ("x", "")),
    ("id string, question int, answer string", ("x", 5, "a1"), ("", "a1")),
    ("id string, question array<int>, answer string", ("x", [], "a1"), ("x", "")),
    ("part string, pos bigint, title string, body string", ("p", 1, "t", "b"), ("t", "b")),
]


@pytest.mark.parametrize("schema,row,wanted", CASES)
def test_resolve_pair(spark, schema, row, wanted):
    got = resolve_pair(spark.createDataFrame([row], schema)).first()
    assert (got.instruction, got.response) == wanted


def test_aliases_go_by_presence(spark):
    df = spark.createDataFrame([(None, "i", "r")], "question string, instruction string, response string")
    got = resolve_aliases(df).first()
    assert (got.instruction, got.response) == (None, "r")


def test_strict_projection_needs_every_column(spark):
    df = spark.createDataFrame([("a", "b")], "instruction string, response string")
    with pytest.raises(AnalysisException):
        project(df, ["instruction", "response", "category"])


def test_tag(spark):
    assert tag(spark.range(1), "domain", "x").first().domain == "x"


def test_clean_pairs_without_the_column_is_empty(spark):
    df = spark.createDataFrame([("a",)], "instruction string")
    assert clean_pairs(df).collect() == []


def test_number_column_is_dropped(spark):
    df = spark.createDataFrame([(5, "b"), (6, "c")], "instruction int, response string")
    assert clean_pairs(df).collect() == []


def test_union_keeps_source_order(spark):
    frames = [
        spark.createDataFrame([(i, f"{name}{i}")], "pos bigint, instruction string")
        for i, name in enumerate("xyz")
    ]
    rows = union_ordered(frames).collect()
    assert sorted((r.src_rank, r.instruction) for r in rows) == [(0, "x0"), (1, "y1"), (2, "z2")]
