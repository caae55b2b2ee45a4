"""Compare a Spark result with its DuckDB twin, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return round(value, 4) + 0.0
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_by_name(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(spark_df, connection, sql: str) -> int:
    found = connection.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(spark_df.columns) == sorted(columns)
    expected = rows_by_name(columns, found.fetchall())
    actual = rows_by_name(spark_df.columns, spark_df.collect())
    missing, extra = list((expected - actual).items())[:3], list((actual - expected).items())[:3]
    assert actual == expected, f"missing {missing}\nextra {extra}"
    return sum(actual.values())
