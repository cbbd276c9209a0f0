"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else f"{number:.6f}"
    if isinstance(value, (datetime, date)):
        return value.replace(tzinfo=None).isoformat() if isinstance(value, datetime) else value.isoformat()
    return str(value)


def rows_of(names: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, connection, sql: str) -> str | None:
    """None if equal, else a short account of the difference."""
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(expected) != len(actual):
        return f"{len(actual)} rows != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{a} != {e}"
    return None
