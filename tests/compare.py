"""Spark result against the equivalent SQL on DuckDB, by value."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, Decimal):
        return ("decimal", v.as_tuple().exponent, v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def differences(df, con, sql: str) -> list[str]:
    """What differs in columns, rows and values; empty when both agree."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    order = sorted(names)
    expected = Counter(
        tuple(_plain(row[names.index(c)]) for c in order) for row in cur.fetchall()
    )
    actual = Counter(
        tuple(_plain(v) for v in row) for row in df.select(*[f"`{c}`" for c in order]).collect()
    )
    missing, extra = expected - actual, actual - expected
    found = []
    if missing:
        found.append(f"{missing.total()} rows missing, such as {next(iter(missing))}")
    if extra:
        found.append(f"{extra.total()} rows too many, such as {next(iter(extra))}")
    return found
