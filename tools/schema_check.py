"""Compare Spark result types with DuckDB oracle types for every query."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tools.oracle_check import duck  # noqa: E402


def spark_type(dt) -> str:
    s = dt.simpleString().upper()
    return {"INT": "INTEGER", "STRING": "VARCHAR", "TINYINT": "TINYINT"}.get(s, s).replace("ARRAY<", "LIST<")


def main(argv):
    from ledgerflow.plans.registry import ORACLES, QUERIES, load_all
    from ledgerflow.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    load_all()
    spark = local_session()
    con = duck(sf_dir)
    for name in argv[2:] or sorted(ORACLES):
        df = QUERIES[name](spark, sf_dir)
        st = {f.name: spark_type(f.dataType) for f in df.schema.fields}
        dt = {r[0]: r[1].upper() for r in con.execute("DESCRIBE " + ORACLES[name]).fetchall()}
        bad = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt)
               if (st.get(c) or "").replace(" ", "") != (dt.get(c) or "").replace(" ", "")}
        print(f"{name:26s} {'OK' if not bad else bad}", flush=True)


if __name__ == "__main__":
    main(sys.argv)
