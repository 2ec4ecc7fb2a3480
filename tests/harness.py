"""Spark-vs-DuckDB comparison in the driver's manner: same column names, same row
count, same multiset of rows (floats compared to 1e-9 relative)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}") if v != v.to_integral_value() else int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name, df, sql):
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    info = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
            "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not info["cols_match"]:
        info["spark_cols"], info["duck_cols"] = s_cols, d_cols
        info["ok"] = False
        return info
    a, b = rows_key(s_cols, s_rows), rows_key(d_cols, d_rows)
    info["ok"] = a == b
    if not info["ok"]:
        sa, sb = set(a), set(b)
        info["only_spark"] = list(sa - sb)[:3]
        info["only_duck"] = list(sb - sa)[:3]
    return info
