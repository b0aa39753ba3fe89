"""Runs a query and its SQL twin on the same tables and compares schema and rows."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


_SAME = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
         "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, run, sql: str, sf_dir: str) -> list[str]:
    """What differs; empty when equal."""
    df = run(spark, sf_dir)
    got = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = _rows(names, cur.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    kinds = dict(df.dtypes)
    for c in cur.description:
        if _SAME.get(kinds[c[0]], kinds[c[0]]) != str(c[1]):
            problems.append(f"type of {c[0]}: {kinds[c[0]]} vs {c[1]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
    if repr(got) != repr(want):
        bad = [(a, b) for a, b in zip(got, want) if repr(a) != repr(b)][:2]
        problems.append(f"values differ, e.g. {bad}")
    if not got:
        problems.append("no rows")
    return problems
