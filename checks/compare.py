"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from . import fixtures as fx


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in fx.BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 6)
    return v


def differences(spark: SparkSession, con, sf_dir: str, run, sql: str) -> str | None:
    """None if columns and rows agree, else a short description."""
    df = run(spark, sf_dir)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    order = sorted(names)
    at = [names.index(n) for n in order]
    want = Counter(tuple(_cell(r[k]) for k in at) for r in want_rows)
    got = Counter(tuple(_cell(v) for v in r) for r in df.select(*[f"`{n}`" for n in order]).collect())
    if want == got:
        return None
    missing, extra = want - got, got - want
    return (f"rows: spark {sum(got.values())} duckdb {sum(want.values())}; missing {sum(missing.values())} e.g. "
            f"{list(missing)[:1]}; extra {sum(extra.values())} e.g. {list(extra)[:1]} columns {order}")
