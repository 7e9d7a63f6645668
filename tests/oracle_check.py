"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names, order-insensitive value hash."""

from __future__ import annotations

import hashlib
import math

import duckdb

from winnow.session import TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return str(v)


def frame_digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(keyed).encode()).hexdigest()
    return sorted(cols), len(rows), h


def duckdb_result(sql: str, sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark_df, sql: str, sf_dir: str):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    d_cols, d_rows = duckdb_result(sql, sf_dir)
    a = frame_digest(s_cols, s_rows)
    b = frame_digest(d_cols, d_rows)
    return a == b, a, b, (s_cols, s_rows, d_cols, d_rows)
