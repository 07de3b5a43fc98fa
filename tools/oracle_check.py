"""Run registered Spark queries and their DuckDB oracles side by side.

Mirrors the driver's gate: same column names, same row count, same
multiset of rows (order-insensitive).  Usage:

    python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, decimal.Decimal):
        return (2, format(v.normalize(), "f") if v == v.to_integral() else format(v.normalize(), "f"))
    if isinstance(v, float):
        if math.isnan(v):
            return (3, "nan")
        return (3, f"{v:.9g}")
    if isinstance(v, int):
        return (2, str(v))
    if isinstance(v, (list, tuple)):
        return (4, tuple(norm(x) for x in v))
    if isinstance(v, dict):
        return (5, tuple(sorted((k, norm(x)) for k, x in v.items())))
    if hasattr(v, "asDict"):
        return (5, tuple(sorted((k, norm(x)) for k, x in v.asDict().items())))
    return (6, str(v))


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    sc, dc = sorted(spark_cols), sorted(duck_cols)
    if sc != dc:
        return f"columns differ: spark-only {sorted(set(sc) - set(dc))} duck-only {sorted(set(dc) - set(sc))}"
    si = [spark_cols.index(c) for c in sc]
    di = [duck_cols.index(c) for c in sc]
    a = sorted(tuple(norm(r[i]) for i in si) for r in spark_rows)
    b = sorted(tuple(norm(r[i]) for i in di) for r in duck_rows)
    if len(a) != len(b):
        return f"row count spark={len(a)} duck={len(b)}"
    from collections import Counter
    only_s = Counter(a) - Counter(b)
    only_d = Counter(b) - Counter(a)
    if only_s or only_d:
        x = next(iter(only_s), None)
        y = next(iter(only_d), None)
        return f"{sum(only_s.values())} spark rows not in duck, {sum(only_d.values())} duck rows not in spark; " \
               f"e.g. spark={dict(zip(sc, x)) if x else None} duck={dict(zip(sc, y)) if y else None}"
    return None


def main(argv):
    from ledgerflow.session import local_session
    from ledgerflow.plans.registry import ORACLES, QUERIES, load_all

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    load_all()
    spark = local_session()
    con = duck(sf_dir)
    ok = True
    for name in (names or list(QUERIES)):
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        rows = df.collect()
        t1 = time.time()
        if name not in ORACLES:
            print(f"{name:28s} rows={len(rows):8d} spark={t1 - t0:6.1f}s  (no oracle: rows-only)", flush=True)
            continue
        cur = con.execute(ORACLES[name])
        drows = cur.fetchall()
        dcols = [d[0] for d in cur.description]
        t2 = time.time()
        err = compare(rows, df.columns, drows, dcols)
        ok &= err is None
        status = "OK " if err is None else "BAD"
        print(f"{name:28s} {status} rows={len(rows):8d} spark={t1 - t0:6.1f}s duck={t2 - t1:5.1f}s"
              + ("" if err is None else f"  {err}"), flush=True)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
