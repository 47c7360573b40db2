"""Run registered queries on Spark and their SQL on DuckDB and compare every value."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when schema and rows agree exactly; floats are compared bit for bit."""
    want = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in want.description}
    want_rows = _sorted(list(want_types), want.fetchall())
    got_types = {n: _TYPES.get(t, t) for n, t in df.dtypes}
    found = []
    if got_types != want_types:
        found.append(f"types differ: {set(got_types.items()) ^ set(want_types.items())}")
        if set(got_types) != set(want_types):
            return found
    got_rows = _sorted(df.columns, df.collect())
    if len(got_rows) != len(want_rows):
        found.append(f"{len(got_rows)} rows, expected {len(want_rows)}")
    else:
        bad = [(a, b) for a, b in zip(got_rows, want_rows) if a != b]
        if bad:
            found.append(f"{len(bad)} rows differ, first: {bad[0][0]} expected {bad[0][1]}")
    return found
