"""Running a query and its oracle on the same tables, and comparing rows as sorted multisets."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path if path.is_file() else path / '*.parquet'}'")
    return con


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(float(value))
    if hasattr(value, "tolist"):
        return str([plain(x) for x in value.tolist()]) if hasattr(value, "__len__") else plain(value.tolist())
    return str(value)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def difference(df, sql: str, con) -> str:
    """Empty if both give the same columns and rows; else what differs first."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = rows(names, found.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows, {len(expected)} expected"
    return next((f"{a} and {b}" for a, b in zip(got, expected, strict=True) if a != b), "")
