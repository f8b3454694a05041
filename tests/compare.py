"""Reading a Spark result, and comparing it with DuckDB on the same tables."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows(df):
    return [tuple(r) for r in df.collect()]


def plain(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def row_set(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(plain(row[i]) for i in order)) for row in rows)


def differences(df, con, sql) -> str | None:
    """None when names, row count and values agree, else what differs."""
    relation = con.execute(sql)
    expected_names = [c[0] for c in relation.description]
    expected = row_set(expected_names, relation.fetchall())
    if sorted(df.columns) != sorted(expected_names):
        return f"columns {sorted(df.columns)} != {sorted(expected_names)}"
    got = row_set(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"first difference\n  spark  {a[:400]}\n  duckdb {b[:400]}"
    return None
