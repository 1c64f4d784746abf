"""Spark results held against DuckDB's, the way a reader would: same columns, same multiset of rows."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        src = p if os.path.isfile(p) else f"{p}/*.parquet"
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{src}')")
    return c


def cell(x):
    if x is None:
        return "~"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)) or type(x).__name__ == "Decimal":
        return f"{float(x):.6g}" if abs(float(x)) < 1e15 else str(int(x))
    if isinstance(x, (dt.datetime, dt.date)):
        return str(x)
    return str(x)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def differences(df, sql: str, con) -> str | None:
    rel = con.sql(sql)
    cols, data = rel.columns, rel.fetchall()
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(cols)}"
    a, b = rows(df.columns, df.collect()), rows(cols, data)
    if a == b:
        return None
    sa, sb = set(a), set(b)
    return f"{len(a)} and {len(b)} rows; only here {list(sa - sb)[:3]}, only in SQL {list(sb - sa)[:3]}"
