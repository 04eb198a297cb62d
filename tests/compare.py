"""Side-by-side run of a query and its DuckDB twin."""

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
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return repr(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def kinds_spark(df) -> dict[str, str]:
    names = {"bigint": "int", "int": "int", "double": "float", "string": "str", "boolean": "bool"}
    return {n: names.get(t, t) for n, t in df.dtypes}


def kinds_duck(rel) -> dict[str, str]:
    names = {"BIGINT": "int", "INTEGER": "int", "DOUBLE": "float", "VARCHAR": "str", "BOOLEAN": "bool"}
    return {n: names.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types, strict=True)}


def differences(spark, con, run, sql: str, sf_dir: str) -> str | None:
    """None if both give the same rows, else what differs."""
    df = run(spark, sf_dir)
    rel = con.sql(sql)
    ks, kd = kinds_spark(df), kinds_duck(rel)
    if sorted(ks.items()) != sorted(kd.items()):
        return f"schema: spark {sorted(ks.items())} duckdb {sorted(kd.items())}"
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(rel.columns, rel.fetchall())
    if len(mine) != len(want):
        return f"rows: spark {len(mine)} duckdb {len(want)}"
    bad = [(a, b) for a, b in zip(mine, want, strict=True) if a != b]
    if bad:
        return f"values: {len(bad)} of {len(mine)} rows differ, columns {sorted(df.columns)}, first {bad[0]}"
    return "empty" if not mine else None
