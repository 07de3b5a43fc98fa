"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is built and executed into Spark's ``noop`` sink (every column
computed, nothing collected); the value per query is the median of
$BENCH_RUNS runs (default 3), build time included (some builders write a
stage table).  Derived input tables (long rows, cost table, grids) are
written once before timing, as stored inputs would be; that one-off time is
reported as ``prepare_inputs``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["alloc_window", "alloc_agg", "alloc_skewed_window", "alloc_skewed_agg", "rule_match",
            "scenario_matrix", "cost_join_two_level", "posting_plan", "unpivot_marks", "expand_cost_rows",
            "template_all"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from ledgerflow.plans.registry import QUERIES, load_all
    from ledgerflow.session import local_session
    from ledgerflow.sources.fixtures import MATERIALIZED, Fixtures

    ncpu = int(cpus) if cpus.isdigit() else os.cpu_count()
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * ncpu), app_name="ledgerflow-bench")
    load_all()

    t0 = time.time()
    fx = Fixtures(spark, sf_dir)
    for v in MATERIALIZED:
        getattr(fx, v)
    prepare = time.time() - t0

    timings: dict[str, float] = {}
    for name in names:
        if name not in QUERIES:
            continue
        samples = []
        for _ in range(runs):
            t = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.time() - t)
        timings[name] = round(statistics.median(samples), 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus, "runs": runs,
                      "prepare_inputs": round(prepare, 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
