"""Local stand-in for the driver's correctness check: run a registered Spark
query and its DuckDB oracle on the same tables, compare row count, column
names and an order-insensitive value hash.

usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tastemine.sources.views import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run(spark, sf_dir, names=None, verbose=True):
    from tastemine.plans.catalog import ORACLE, QUERIES

    con = duck(sf_dir)
    results = {}
    for name in names or list(QUERIES):
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e)[:400])
            print(name, "SPARK-ERROR", str(e)[:800], flush=True)
            continue
        ts = time.time() - t0
        if name not in ORACLE:
            results[name] = ("rows-only", len(srows))
            print(f"{name}: rows-only {len(srows)} rows ({ts:.1f}s)", flush=True)
            continue
        try:
            rel = con.sql(ORACLE[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL-ERROR", str(e)[:400])
            print(name, "SQL-ERROR", str(e)[:800], flush=True)
            continue
        hs, ls = digest(srows, scols)
        hd, ld = digest(drows, dcols)
        ok = len(srows) == len(drows) and sorted(scols) == sorted(dcols) and hs == hd
        results[name] = ("MATCH" if ok else "MISMATCH", len(srows), len(drows))
        print(f"{name}: {'MATCH' if ok else 'MISMATCH'} spark={len(srows)} duck={len(drows)} ({ts:.1f}s)", flush=True)
        if not ok and verbose:
            if sorted(scols) != sorted(dcols):
                print("   cols spark", scols, "\n   cols duck ", dcols)
            only_s = sorted(set(ls) - set(ld))[:5]
            only_d = sorted(set(ld) - set(ls))[:5]
            print("   spark-only", only_s)
            print("   duck-only ", only_d)
    return results


if __name__ == "__main__":
    from tastemine.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session()
    res = run(spark, sf_dir, names)
    bad = [k for k, v in res.items() if v[0] not in ("MATCH", "rows-only")]
    print("SUMMARY", len(res), "queries;", "bad:", bad)
