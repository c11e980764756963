"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python tools/oracle_check.py [--exact] [sf_dir] [name ...]

Compares row count, column names and an order-insensitive hash of the
values (floats rounded to 6 decimals; ``--exact`` hashes ``repr`` of every
float instead), like the round's correctness gate.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.plans.registry import ORACLES, QUERIES, load_all  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.sources.tables import TABLES, table_path  # noqa: E402


EXACT = False


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(v) if EXACT else f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def main():
    global EXACT
    args = sys.argv[1:]
    if args and args[0] == "--exact":
        EXACT, args = True, args[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    load_all()
    names = args or sorted(QUERIES)
    spark = build_session(os.environ.get("ORACLE_MASTER", "local[8]"), 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK-ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLES:
            print(f"{name:32s} rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(ORACLES[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SQL-ERROR {str(e)[:300]}")
            bad += 1
            continue
        hs, ls = digest(srows, cols)
        ho, lo = digest(orows, ocols)
        ok = sorted(cols) == sorted(ocols) and len(srows) == len(orows) and hs == ho
        status = "OK " if ok else "MISMATCH"
        print(f"{name:32s} {status} rows={len(srows)}/{len(orows)} {ts:.1f}s")
        if not ok:
            bad += 1
            if sorted(cols) != sorted(ocols):
                print("   cols spark:", sorted(cols), "\n   cols sql:  ", sorted(ocols))
            else:
                a, b = set(ls), set(lo)
                print("   spark-only:", sorted(a - b)[:3])
                print("   sql-only:  ", sorted(b - a)[:3])
    print(f"{bad} problem(s) of {len(names)}")
    spark.stop()


if __name__ == "__main__":
    main()
