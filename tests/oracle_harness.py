"""Local stand-in for the driver's gate: run a Spark query and its DuckDB SQL
on the same parquet tables and compare row count, column names and an
order-insensitive hash of the values (doubles rounded)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os

STRICT = os.environ.get("STRICT") == "1"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if STRICT:
            return repr(float(v))
        return f"{v:.6g}" if abs(v) >= 1e15 else f"{round(v, 4):.4f}"
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(float(v)) if STRICT else f"{float(v):.4f}"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, dict):
        return str(sorted((str(k), _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    hs, ls = digest(s_cols, s_rows)
    hd, ld = digest(d_cols, d_rows)
    out = {"rows": (len(s_rows), len(d_rows)), "cols_ok": sorted(s_cols) == sorted(d_cols),
           "hash_ok": hs == hd}
    if not out["cols_ok"]:
        out["cols"] = (sorted(s_cols), sorted(d_cols))
    if not out["hash_ok"]:
        a, b = set(ls), set(ld)
        out["only_spark"] = sorted(a - b)[:3]
        out["only_duck"] = sorted(b - a)[:3]
    return out
