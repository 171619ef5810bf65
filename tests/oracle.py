"""Run a query and its checking SQL on the same files and compare them."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, rows):
    """Rows as sorted tuples with the columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


def difference(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = dict(zip(names, [str(c[1]) for c in cursor.description], strict=True))
    expected = rows_of(names, cursor.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    bad = [(g, e) for g, e in zip(got, expected, strict=True) if [*map(repr, g)] != [*map(repr, e)]]
    return f"{len(bad)} rows differ, first {bad[0]} types {types}" if bad else None
