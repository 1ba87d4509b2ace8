"""Compare a Spark result with a DuckDB result as multisets of rows.

Used by the tests and by ``check.py``; values are normalised to plain
Python types so that equal results compare equal whatever engine made them.
"""

from __future__ import annotations

import datetime as dt
import math

import pandas as pd


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows(names: list[str], records) -> list[tuple]:
    """Rows as tuples in sorted-column order, normalised, sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_df, con, sql: str) -> dict:
    s_names = spark_df.columns
    s_rows = spark_df.collect()
    cur = con.execute(sql)
    o_names = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    res = {
        "rows_spark": len(s_rows), "rows_oracle": len(o_rows),
        "cols_match": sorted(s_names) == sorted(o_names),
    }
    if res["cols_match"]:
        rs, ro = rows(s_names, s_rows), rows(o_names, o_rows)
        res["values_match"] = rs == ro
        if not res["values_match"]:
            res["first_diffs"] = [(a, b) for a, b in zip(rs, ro) if a != b][:3]
    else:
        res["values_match"] = False
        res["cols"] = (s_names, o_names)
    return res
