"""Strict comparison of a registered query with its SQL twin."""
from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, decimal.Decimal):
        return ("DECIMAL", str(v))
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(_cell(r[i])) for i in order) for r in rows)


def compare(df, con, sql):
    """None when equal, else a short description of the difference."""
    names = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_names = [c[0] for c in cur.description]
    types = [str(c[1]) for c in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = rows_of(names, got), rows_of(want_names, want)
    if a != b:
        only = [(p, q) for p, q in zip(a, b) if p != q][:2]
        return f"{sum(p != q for p, q in zip(a, b))} rows differ; {sorted(names)}; {only}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "boolean": "BOOLEAN"}
    spark_types = dict(df.dtypes)
    loose = [f"{n}:{spark_types[n]}/{t}" for n, t in zip(want_names, types)
             if kinds.get(spark_types[n], spark_types[n]) != t and "NULL" not in t]
    return f"types {loose}" if loose else None
