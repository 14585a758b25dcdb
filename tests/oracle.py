"""Run one registered query and its check, and compare the rows."""

from __future__ import annotations

import math

import duckdb

from agentlake.sources.tables import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat() if hasattr(value, "tzinfo") else value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )


def compare(df, con, sql):
    """None when equal, else a short text."""
    result = con.sql(sql)
    if sorted(df.columns) != sorted(result.columns):
        return f"columns {sorted(df.columns)} != {sorted(result.columns)}"
    kinds = {c: _kind(str(t)) for c, t in zip(result.columns, result.types)}
    mine = {c: _kind(t) for c, t in df.dtypes}
    if kinds != mine:
        return f"types {[(c, mine[c], kinds[c]) for c in kinds if kinds[c] != mine[c]]}"
    left = rows_of(df.columns, df.collect())
    right = rows_of(result.columns, result.fetchall())
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"spark {a}\nduck  {b}"
    return None if left else "no rows"


def _kind(name: str) -> str:
    name = name.lower()
    return {"varchar": "string", "integer": "int", "int32": "int", "timestamp_ntz": "timestamp",
            "timestamp with time zone": "timestamp"}.get(name, name)
