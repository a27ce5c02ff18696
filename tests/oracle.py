"""Compare registered queries with their SQL on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(row[i]).__name__, _value(row[i])) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns, types of values and rows; otherwise what differs."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    want = _rows(names, found.fetchall())
    have = _rows(df.columns, [tuple(r) for r in df.collect()])
    if want == have:
        return None
    extra, missing = have - want, want - have
    return f"{sum(have.values())} vs {sum(want.values())} rows; extra {list(extra)[:2]}; missing {list(missing)[:2]}"
