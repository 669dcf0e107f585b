"""Compares a query with its SQL on the same tables, as sets of rows with columns by name."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()[:26]
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, bool):
        return v
    return float(v) if isinstance(v, int) else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows), sorted(names)


def differences(spark, sf_dir, query, sql, con):
    df = query(spark, sf_dir)
    a, na = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    b, nb = rows_of([d[0] for d in cur.description], cur.fetchall())
    if na != nb:
        return f"columns {na} {nb}"
    if a != b:
        left, right = set(a), set(b)
        x, y = [r for r in a if r not in right], [r for r in b if r not in left]
        return f"rows {len(a)} {len(b)}; only here {x[:3]}; only there {y[:3]}"
    return ""
