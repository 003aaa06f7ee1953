"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name, fn, sql, sf_dir, con):
    t = time.time()
    sp = fn(spark, sf_dir).toPandas()
    ts = time.time() - t
    if sql is None:
        return dict(name=name, ok=None, rows=len(sp), spark_s=round(ts, 2))
    dk = con.execute(sql).df()
    res = dict(name=name, rows=len(sp), duck_rows=len(dk), spark_s=round(ts, 2))
    if sorted(sp.columns) != sorted(dk.columns):
        res.update(ok=False, why=f"columns {sorted(sp.columns)} vs {sorted(dk.columns)}")
        return res
    a, b = rows(sp), rows(dk)
    if a == b:
        res["ok"] = True
    else:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res.update(ok=False, why=f"{len(a)} vs {len(b)} rows; first diffs {bad}")
    return res


def main():
    from tidecast.session import local_session
    import __spark_entry__ as E
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sq = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, name, fn, sq.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad}")


if __name__ == "__main__":
    main()
