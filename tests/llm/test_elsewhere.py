"""All corpus queries from another folder, with workers that do not have the package on their path."""

from __future__ import annotations

import subprocess
import sys

import __spark_entry__ as contract

SCRIPT = """
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("__spark_entry__", {path!r})
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
names = [n for n in contract.queries() if n.startswith("op") and n.split("_")[0][2:].isdigit()] + ["length_budget_subwords", "scan_one_line_arrays"]
assert len(names) == 15, names
for name in names:
    assert contract.queries()[name](spark, "/root/testdata/sf0.001").count() > 0 or name == "op11_phrases", name
"""


def test_queries_run_without_the_package_on_the_workers(tmp_path):
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(path=contract.__file__)], cwd=tmp_path, timeout=900, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr[-3000:]
