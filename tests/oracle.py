"""Comparing a query with its SQL in DuckDB."""

from __future__ import annotations

import decimal
from pathlib import Path

import duckdb


def connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for p in Path(sf).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def plain(v):
    if v is None or isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return repr(round(float(v), 6) + 0.0)
    if isinstance(v, (list, tuple)):  # what is inside is compared exactly
        return "[" + ",".join(map(repr, v)) + "]"
    return str(v)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def same(df, con: duckdb.DuckDBPyConnection, statement: str) -> None:
    got, want = [tuple(r) for r in df.collect()], con.sql(statement)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, got) == rows(want.columns, want.fetchall())
