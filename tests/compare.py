"""Comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, db, sql: str) -> list[str]:
    """What differs, as text; empty if the results are equal."""
    found = db.sql(sql)
    expected_rows, rows = found.fetchall(), [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(found.columns):
        return [f"columns {sorted(df.columns)} / {sorted(found.columns)}"]
    if len(rows) != len(expected_rows):
        return [f"{len(rows)} rows, expected {len(expected_rows)}"]
    ours, theirs = _rows(df.columns, rows), _rows(found.columns, expected_rows)
    return [f"{a} / {b}" for a, b in zip(ours, theirs) if a != b][:5]
