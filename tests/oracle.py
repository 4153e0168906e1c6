"""Compare registered queries with their SQL in DuckDB, ignoring row order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, db, sql):
    """None if equal, else what differs."""
    found = db.sql(sql)
    if sorted(found.columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} expected {sorted(found.columns)}"
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    theirs = rows_of(found.columns, found.fetchall())
    if ours == theirs:
        return None
    only = [a for a in ours if a not in set(theirs)][:2]
    missing = [b for b in theirs if b not in set(ours)][:2]
    return f"{len(ours)} rows, expected {len(theirs)}; only ours {only!r:.600}; only theirs {missing!r:.600}"
