"""Run registered queries against their DuckDB oracle, like the driver does.

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
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
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 9)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, key: str, sf_dir: str, con=None) -> tuple[bool, str]:
    from citymarts.plans.catalog import QUERIES
    from citymarts.plans.oracle import ORACLE
    con = con or duck(sf_dir)
    t = time.time()
    sdf = QUERIES[key](spark, sf_dir)
    s = sdf.toPandas()
    ts = time.time() - t
    o = con.execute(ORACLE[key]).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns {sorted(s.columns)} vs {sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"rows {len(s)} vs {len(o)}"
    a, b = canon(s), canon(o)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(s)} rows, spark {ts:.2f}s"


def main(argv: list[str]) -> int:
    from citymarts.plans.catalog import QUERIES
    from citymarts.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or sorted(QUERIES)
    spark = build_session("local[8]")
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            ok, msg = compare(spark, k, sf_dir, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k}: {msg}", flush=True)
    print(f"{len(keys) - bad}/{len(keys)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
