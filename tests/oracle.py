"""Spark-vs-DuckDB comparison used by the oracle tests.

Mirrors the correctness gate: same row count, same column names, compatible
types, and equal values after sorting columns by name and rows by value.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from pitwall.sources.tables import TABLES, table_path

_TYPE_FAMILY = {
    "int": "int32", "integer": "int32", "bigint": "int64", "smallint": "int16",
    "tinyint": "int8", "double": "float64", "float": "float32", "string": "string",
    "varchar": "string", "boolean": "bool", "date": "date", "timestamp": "timestamp",
    "timestamp_ntz": "timestamp", "timestamp with time zone": "timestamp",
}


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(sf_dir, t)}')")
    return con


def _family(t: str) -> str:
    t = t.lower()
    if t.startswith("decimal"):
        return "decimal"
    if t.startswith("array") or t.startswith("struct") or t.startswith("map") or "[]" in t:
        return "nested"
    return _TYPE_FAMILY.get(t, t)


def _norm(v):
    if v is None:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def compare(spark_df, con, sql: str) -> list[str]:
    """Return a list of differences (empty when equal)."""
    problems = []
    rel = con.sql(sql)
    d_types = {n: _family(str(t)) for n, t in zip(rel.columns, rel.types)}
    d = rel.df()
    s_types = {f.name: _family(f.dataType.simpleString()) for f in spark_df.schema.fields}
    s = spark_df.toPandas()
    if sorted(s.columns) != sorted(d.columns):
        return [f"columns differ: spark {sorted(s.columns)} vs sql {sorted(d.columns)}"]
    for c in s.columns:
        if s_types[c] != d_types[c]:
            problems.append(f"type of {c}: spark {s_types[c]} vs sql {d_types[c]}")
    if len(s) != len(d):
        problems.append(f"row count: spark {len(s)} vs sql {len(d)}")
        return problems
    cols = sorted(s.columns)

    def rows(df):
        out = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
        return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))

    rs, rd = rows(s), rows(d)
    bad = [(a, b) for a, b in zip(rs, rd) if a != b]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: spark {bad[0][0]} vs sql {bad[0][1]}")
    return problems
