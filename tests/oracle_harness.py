"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Mirrors the driver's check: row count, sorted column names, and an
order-insensitive hash of the values. Usage:
    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

STRICT = os.environ.get("ORACLE_STRICT") == "1"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v) if STRICT else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    return str(v)


def table_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck_con(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run(sf_dir, names=None, spark=None, verbose=True):
    import __spark_entry__ as E
    from tokscope.session import local_session
    spark = spark or local_session()
    qs, orc = E.queries(), E.oracle_sql()
    con = duck_con(sf_dir)
    out = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        ts = time.time() - t0
        res = {"rows": len(srows), "spark_sec": round(ts, 2)}
        if name in orc:
            cur = con.execute(orc[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
            sh, sl = table_hash(scols, srows)
            dh, dl = table_hash(dcols, drows)
            res.update(oracle_rows=len(drows), cols_ok=sorted(scols) == sorted(dcols),
                       hash_ok=sh == dh)
            if verbose and not (res["hash_ok"] and res["cols_ok"]):
                print("  spark cols", sorted(scols), "\n  duck  cols", sorted(dcols))
                a, b = set(sl), set(dl)
                for x in list(a - b)[:3]:
                    print("  spark only:", x[:300])
                for x in list(b - a)[:3]:
                    print("  duck  only:", x[:300])
        out[name] = res
        if verbose:
            print(name, res, flush=True)
    return out


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    r = run(sf, names)
    bad = [k for k, v in r.items() if v.get("hash_ok") is False or v.get("cols_ok") is False]
    print("MISMATCH:", bad)
