"""Compare a query with its SQL on the same Parquet files."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(t) -> str:
    text = str(t).lower()
    for prefix, kind in (("timestamp", "timestamp"), ("decimal", "decimal"), ("large_string", "string")):
        if text.startswith(prefix):
            return kind
    return text


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences in columns, types, row count or values; empty when all agree."""
    ours, theirs = df.toArrow(), con.sql(sql).to_arrow_table()
    problems = []
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return [f"columns {sorted(ours.column_names)} != {sorted(theirs.column_names)}"]
    names = sorted(ours.column_names)
    for n in names:
        a, b = _kind(ours.schema.field(n).type), _kind(theirs.schema.field(n).type)
        if a != b:
            problems.append(f"type of {n}: {a} != {b}")
    if ours.num_rows != theirs.num_rows:
        problems.append(f"rows {ours.num_rows} != {theirs.num_rows}")
    rows_a = Counter(zip(*[ours.column(n).to_pylist() for n in names]))
    rows_b = Counter(zip(*[theirs.column(n).to_pylist() for n in names]))
    if rows_a != rows_b:
        problems.append(f"only spark {list((rows_a - rows_b))[:2]}; only sql {list((rows_b - rows_a))[:2]}")
    if ours.num_rows == 0:
        problems.append("no rows")
    return problems
