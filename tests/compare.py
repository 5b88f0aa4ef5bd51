"""Order-free comparison of a Spark result and a DuckDB result."""

from __future__ import annotations

import datetime
import decimal
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


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_value(row[i]) for i in order) for row in rows)


_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


def type_difference(df, con, sql: str) -> str | None:
    """None when every column has the same type on both sides."""
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    got = {name: _TYPES.get(kind, kind) for name, kind in df.dtypes}
    return None if got == want else f"types {got} != {want}"


def difference(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs first."""
    got_names, got = normalised(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_names, want = normalised([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference\n  spark  {g}\n  duckdb {w}"
    return None
