"""Compares a query with its SQL on DuckDB: columns by name, rows in any order, exact values."""

from __future__ import annotations

import datetime
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    """Values as both engines have them."""
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(df, sql: str, sf_dir: str) -> None:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    have_names, have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert have_names == want_names
    assert len(have) == len(want), (len(have), len(want))
    wrong = [(h, w) for h, w in zip(have, want, strict=True) if h != w]
    assert not wrong, (len(wrong), wrong[:3])
