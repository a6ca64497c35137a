"""Compare a registered query with its SQL on the same files."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """What differs, or None."""
    got = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(df.columns, got), _rows(names, want)
    if a == b:
        return None
    left, right = set(map(repr, a)), set(map(repr, b))
    return (f"rows {len(a)} vs {len(b)}; columns {sorted(names)}; only spark {sorted(left - right)[:3]}; "
            f"only sql {sorted(right - left)[:3]}")
