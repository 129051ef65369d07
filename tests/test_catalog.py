from __future__ import annotations

import subprocess
import sys

import pytest

import __spark_entry__ as contract
from catalog.oracle import ORACLE as SQL
from catalog.queries import QUERIES
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, SQL[name]) == []


def test_harness_sees_a_planted_difference(spark, con):
    df = QUERIES["type_guard"](spark, SF)
    assert differences(df, con, SQL["type_guard"].replace("text FROM", "text || '.' AS text FROM"))
    assert differences(df, con, SQL["type_guard"].replace("item_id,", "item_id::INTEGER AS item_id,"))
    assert differences(df, con, SQL["type_guard"] + " WHERE item_id > 0")


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["instruction", "response", "split_pos", "split", "split_row"]
    assert df.count() > 0


FROM_ELSEWHERE = """
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("__spark_entry__", {path!r})
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("scan_json_array", "map_rows_pandas"):
    assert contract.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
"""


def test_python_workers_do_not_need_the_package(tmp_path):
    script = FROM_ELSEWHERE.format(path=contract.__file__)
    subprocess.run([sys.executable, "-c", script], cwd=tmp_path, check=True, timeout=300)


@pytest.mark.parametrize("name", ["first_record_preview", "load_split_files_in_order"])
def test_files_are_written_by_as_many_tasks_as_the_settings_ask_for(spark, monkeypatch, name):
    """With a fixed number of tasks each would read a fixed share of any table."""
    asked, by_range = [], type(spark.range(1)).repartitionByRange

    def noted(self, *args):
        asked.append(args)
        return by_range(self, *args)

    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", noted)
    QUERIES[name](spark, "/root/testdata/sf0.001")
    assert asked and not any(isinstance(args[0], int) for args in asked)
