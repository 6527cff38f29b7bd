"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return float(f"{value:.9g}")
    return value


def _rows(rows, order):
    cleaned = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cleaned, key=lambda row: tuple((value is None, str(type(value).__name__), str(value)) for value in row))


def compare(df, connection, sql: str) -> str:
    """'' when both agree, else the first difference."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    expected = answer.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ordered = sorted(names)
    left = _rows([tuple(r) for r in df.collect()], [df.columns.index(n) for n in ordered])
    right = _rows(expected, [names.index(n) for n in ordered])
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for mine, theirs in zip(left, right):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{ordered}: {mine} != {theirs}"
    return ""
