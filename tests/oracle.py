"""Comparing a Spark result with the result of its SQL in DuckDB."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(directory: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    return connection


def _plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (int, float, Decimal)):
        return repr(float(value))
    return repr(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([names[i] for i in order]), sorted([tuple(_plain(r[i]) for i in order) for r in data], key=repr)


def spark_rows(df):
    return rows(df.columns, df.collect())


def duck_rows(connection, sql):
    result = connection.sql(sql)
    return rows(result.columns, result.fetchall())
