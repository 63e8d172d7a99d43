"""Run a query in Spark and its SQL in DuckDB on the same tables and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{file}')")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple(map(repr, r)))


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    spark_cols, spark_rows = _sorted([tuple(r) for r in df.collect()], df.columns)
    relation = con.sql(sql)
    duck_cols, duck_rows = _sorted(relation.fetchall(), relation.columns)
    if spark_cols != duck_cols:
        return f"columns {spark_cols} != {duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} != {len(duck_rows)}"
    bad = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    if bad:
        return f"{len(bad)} rows differ, e.g. {bad[0]}"
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    types = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
    }
    off = {c: (t, kinds[c]) for c, t in df.dtypes if types.get(t) != kinds[c]}
    return f"types {off}" if off else None
