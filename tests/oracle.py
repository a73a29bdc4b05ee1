"""Comparing a query with its SQL in DuckDB over the same tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def canonical(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else round(x, 6)
        if hasattr(x, "to_integral_value"):
            return round(float(x), 6)
        return x

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> None:
    """Fail unless both sides have the same columns and rows."""
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(df.columns)
    expected = canonical(theirs.fetchall(), names)
    found = canonical([tuple(r) for r in df.collect()], df.columns)
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert a == b
