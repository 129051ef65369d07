"""Queries that SQL can express, compared with DuckDB over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from pairloom.llm.queries import ORACLE, QUERIES
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
