"""Compares a Spark result with DuckDB's: column names, types and the multiset of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    actual_types = {name: TYPES.get(dtype, dtype) for name, dtype in df.dtypes}
    found = []
    if actual_types != expected_types:
        found.append(f"types {actual_types} != {expected_types}")
    if set(actual_types) != set(expected_types):
        return found
    names = sorted(actual_types)
    actual = Counter(tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    wanted = Counter(relation.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall())
    for label, rows in (("only in Spark", actual - wanted), ("only in SQL", wanted - actual)):
        if rows:
            example = str(next(iter(rows)))[:300]
            found.append(f"{sum(rows.values())} rows {label}, such as {example}")
    return found
