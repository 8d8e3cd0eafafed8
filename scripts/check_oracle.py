"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python scripts/check_oracle.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import sys
import time

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

import duckdb  # noqa: E402

from demandflow.plans.registry import load_all  # noqa: E402
from demandflow.session import build_session  # noqa: E402
from demandflow.sources.observations import TABLES  # noqa: E402


def canon(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, repr(round(v, 9) + 0.0))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, (int, bool)):
        return (2, repr(float(v)))
    return (3, str(v))


def rows_of(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return sorted(tuple(canon(t[i]) for i in order) for t in tuples)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in sys.argv[1:] if not a.startswith("/")]
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    reg = load_all()
    ok = bad = rows_only = 0
    for name, (fn, sql) in reg.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {name}: {str(e).splitlines()[0][:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if sql is None:
            print(f"ROWS  {name}: {len(srows)} rows ({ts:.1f}s)")
            rows_only += 1
            continue
        try:
            res = con.execute(sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SQL {name}: {str(e).splitlines()[0][:300]}")
            bad += 1
            continue
        if sorted(c.lower() for c in scols) != sorted(c.lower() for c in dcols):
            print(f"COLS  {name}: spark={scols} duck={dcols}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a == b:
            ok += 1
            print(f"OK    {name}: {len(srows)} rows ({ts:.1f}s)")
        else:
            bad += 1
            diff = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            print(f"DIFF  {name}: spark {len(a)} rows, duck {len(b)} rows; first diff at {diff}:"
                  f"\n      spark {a[diff] if diff < len(a) else None}\n      duck  {b[diff] if diff < len(b) else None}")
    print(f"ok={ok} bad={bad} rows_only={rows_only}")


if __name__ == "__main__":
    main()
