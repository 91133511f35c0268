"""Comparison of a Spark result with the rows of the same query in DuckDB."""

from __future__ import annotations

import datetime
import math

import duckdb
from pyspark.sql import DataFrame

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPE_NAMES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
}


def connect(sf_dir: str, inside: str = "") -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in BASE_TABLES:
        path = f"{sf_dir}/{name}.parquet/{inside}".rstrip("/")
        db.execute(f"create view {name} as select * from '{path}'")
    return db


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted(rows) -> list[tuple]:
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def differences(result: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: columns, types, row count or values. Empty if nothing does."""
    expected = db.sql(sql)
    names = sorted(result.columns)
    if names != sorted(expected.columns):
        return [f"columns {names} against {sorted(expected.columns)}"]
    found = []
    spark_types = dict(result.dtypes)
    sql_types = {n: TYPE_NAMES.get(str(t), str(t)) for n, t in zip(expected.columns, expected.types)}
    for name in names:
        if spark_types[name] != sql_types[name]:
            found.append(f"type of {name}: {spark_types[name]} against {sql_types[name]}")
    ours = _sorted(result.select(*names).collect())
    theirs = _sorted(expected.select(*(duckdb.ColumnExpression(n) for n in names)).fetchall())
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows against {len(theirs)}")
    elif ours != theirs:
        pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
        found.append(f"{len(pairs)} rows differ, first {pairs[0]}")
    return found
