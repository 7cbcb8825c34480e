"""Compares a registered query with its SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, bool) or v is None:
        return repr(v)
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when both agree, else what differs."""
    return compare_rows(spark_df.columns, spark_df.collect(), con, sql)


def compare_rows(names: list[str], rows: list, con, sql: str) -> str | None:
    ours = [tuple(r) for r in rows]
    cur = con.execute(sql)
    other_names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(names) != sorted(other_names):
        return f"columns {sorted(names)} vs {sorted(other_names)}"
    left, right = _rows(names, ours), _rows(other_names, theirs)
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"\n  spark  {a}\n  duckdb {b}"
    return None
