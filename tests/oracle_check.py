"""Run registered queries in Spark and their DuckDB oracles; compare
row count, column names and an order-insensitive value hash.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as E
    from textloom.session import get_spark

    spark = get_spark("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows ({dt:.1f}s)")
            continue
        try:
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and hs == hd
        if ok:
            print(f"OK   {name}: {len(srows)} rows ({dt:.1f}s)")
        else:
            bad += 1
            print(f"FAIL {name}: cols {sorted(scols)} vs {sorted(dcols)}; rows {len(srows)} vs "
                  f"{len(drows)}")
            sl, dl = set(ls), set(ld)
            for x in list(sl - dl)[:3]:
                print("   spark only:", x[:300])
            for x in list(dl - sl)[:3]:
                print("   duck  only:", x[:300])
    print(f"{bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
