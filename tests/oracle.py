"""Compare a query with its SQL the way a result set is compared: columns by name, rows in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(x):
    if isinstance(x, bool):
        return str(int(x))
    if isinstance(x, float) and math.isfinite(x):
        return f"{x:.5f}" if x != int(x) else str(int(x))
    if x is None:
        return "NULL"
    try:
        f = float(x)
        return str(int(f)) if f == int(f) and not isinstance(x, str) else str(x) if isinstance(x, str) else f"{f:.5f}"
    except (TypeError, ValueError):
        return str(x)


def rows(columns: list[str], data) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in data)


def difference(df, con, sql: str) -> str:
    """'' if both agree, else what differs."""
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want = rows([c[0] for c in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    if got[1] == want[1]:
        return ""
    a, b = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
    return f"{len(got[1])} and {len(want[1])} rows; here only {sorted(a)[:3]}, there only {sorted(b)[:3]}"
