"""Compare a Spark result with DuckDB's, regardless of row and column order."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return repr(value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> list[str]:
    """What differs; empty if nothing does."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return [f"columns: spark {sorted(frame.columns)}, sql {sorted(names)}"]
    left = _rows(frame.columns, frame.collect())
    right = _rows(names, expected)
    if len(left) != len(right):
        return [f"rows: spark {len(left)}, sql {len(right)}"] + _sample(left, right)
    return _sample(left, right)


def _sample(left, right) -> list[str]:
    only_left, only_right = set(left) - set(right), set(right) - set(left)
    out = [f"spark only: {str(row)[:300]}" for row in sorted(only_left)[:3]]
    out += [f"sql only: {str(row)[:300]}" for row in sorted(only_right)[:3]]
    if not out and left != right:
        out.append("row multiplicities differ")
    return out
