"""Compare a query's rows with the rows of its SQL on the checking engine."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, int):
        return float(value) if abs(value) < 2 ** 53 else value
    return str(value)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    values = [tuple(_plain(row[index]) for index in order) for row in rows]
    return sorted(columns), sorted(values, key=repr)


def differences(frame, connection, text: str, show: int = 3) -> str | None:
    """None when both sides agree, else a short description."""
    result = connection.execute(text)
    theirs = rows_of([column[0] for column in result.description], result.fetchall())
    ours = rows_of(frame.columns, frame.collect())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] == theirs[1]:
        return None
    left, right = set(ours[1]), set(theirs[1])
    return (f"rows {len(ours[1])} / {len(theirs[1])}\n  columns: {ours[0]}\n  only ours: {sorted(left - right, key=repr)[:show]}"
            f"\n  only sql:  {sorted(right - left, key=repr)[:show]}")
