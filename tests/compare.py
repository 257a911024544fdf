"""Compare a Spark result with a DuckDB result: columns by name, rows as a multiset."""

from __future__ import annotations

import glob
import math
import os

import duckdb

_KINDS = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int", "string": "text", "double": "real",
    "BIGINT": "int", "INTEGER": "int", "VARCHAR": "text", "DOUBLE": "real", "HUGEINT": "int",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    flat = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(flat, key=lambda r: tuple((v is None, str(v)) for v in r))


def mismatch(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    relation = con.sql(sql)
    spark_types = {n: _KINDS.get(t, t) for n, t in df.dtypes}
    duck_types = {n: _KINDS.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    exact = {n: t for n, t in df.dtypes}
    wide = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}
    loose = {n: (exact[n], str(t)) for n, t in zip(relation.columns, relation.types)
             if n in exact and wide.get(exact[n]) != str(t)}
    if spark_types != duck_types:
        return f"schema: {spark_types} vs {duck_types}"
    names_a, rows_a = _rows(df.columns, df.collect())
    names_b, rows_b = _rows(relation.columns, relation.fetchall())
    if len(rows_a) != len(rows_b):
        return f"row count: {len(rows_a)} vs {len(rows_b)}"
    for left, right in zip(rows_a, rows_b):
        if left != right:
            return f"rows differ: {names_a}\n  {left}\n  {right}"
    if loose:
        return f"width: {loose}"
    return None
