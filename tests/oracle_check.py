"""Run registered queries on Spark and their SQL oracle on DuckDB and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive multiset of
normalized rows (floats to 1e-6 relative, timestamps as ISO text).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"{v:.9g}" if abs(v) >= 1e-6 else "0"
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    s = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return {"name": name, "status": "rows-only", "rows": len(s), "spark_s": round(t1 - t0, 2)}
    o = con.sql(sql).df()
    res = {"name": name, "rows": len(s), "oracle_rows": len(o), "spark_s": round(t1 - t0, 2)}
    if sorted(s.columns) != sorted(o.columns):
        res.update(status="COLUMNS", spark_cols=sorted(s.columns), oracle_cols=sorted(o.columns))
        return res
    a, b = _rows(s), _rows(o)
    if a == b:
        res["status"] = "ok"
    else:
        sa, sb = set(a), set(b)
        res.update(status="VALUES", only_spark=list(sa - sb)[:3], only_oracle=list(sb - sa)[:3])
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from farespark.session import get_spark

    spark = get_spark("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "status": "ERROR", "error": str(exc)[:600]}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names or qs) - bad} ok / {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
