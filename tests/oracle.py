"""Runs a query and its SQL and compares the rows, whatever their order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    found = df.collect()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours, theirs = rows_of(df.columns, found), rows_of(names, expected)
    if ours == theirs:
        return None
    only_ours = [r for r in ours if r not in set(theirs)][:3]
    only_theirs = [r for r in theirs if r not in set(ours)][:3]
    return f"{len(ours)} rows != {len(theirs)}; only here {only_ours}; only there {only_theirs}"
