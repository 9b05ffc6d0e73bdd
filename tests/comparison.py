"""Compare a query with its SQL, whole result against whole result."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    database = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            database.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return database


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def rows(columns, records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in records]
    return sorted(cells, key=lambda r: tuple((c is not None, str(type(c)), c) for c in r))


def difference(df, database, sql: str) -> str | None:
    """None if both give the same rows, otherwise what differs."""
    found = database.execute(sql)
    names = [c[0] for c in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    actual = rows(df.columns, [tuple(r) for r in df.collect()])
    expected = rows(names, found.fetchall())
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{a} != {e}"
    return None
