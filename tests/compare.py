"""Spark result against DuckDB result: names, types, row count, values, in any row order."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

STAR = ("region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations").split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in STAR:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def assert_equal(df, connection, sql):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    types = dict(zip(names, (str(column[1]) for column in result.description)))
    assert sorted(df.columns) == sorted(names)
    assert {name: TYPES[kind] for name, kind in df.dtypes} == types
    expected = _rows(names, result.fetchall())
    found = _rows(df.columns, df.collect())
    assert found == expected
    assert found, "an empty result checks nothing"
