"""Plan-shape tests: no cartesian products, no row-at-a-time Python, no
single-partition exchanges in any registered query; rule joins broadcast."""

import pytest

from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BatchEvalPython", "SinglePartition", "BroadcastNestedLoopJoin")
SAMPLE = ["alloc_window", "alloc_agg", "alloc_skewed_agg", "posting_plan", "scenario_matrix", "template_all",
          "edge_keys", "expand_cost_rows", "row_ids", "upsert_costs", "cost_join_two_level"]


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SAMPLE)
def test_plan_shape(spark, name):
    from ledgerflow.plans.registry import QUERIES, load_all
    load_all()
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in text, f"{name}: {bad} in plan"


def test_rule_join_is_broadcast(spark):
    from ledgerflow.plans.registry import QUERIES, load_all
    load_all()
    text = plan_text(QUERIES["rule_match"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text


def test_scan_pushdown_and_pruning(spark):
    from ledgerflow.plans.registry import QUERIES, load_all
    load_all()
    df = QUERIES["alloc_window"](spark, SF_SMALL)
    text = plan_text(df)
    # the scans read only the columns the allocation needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," in text
    for unused in ("l_quantity", "l_shipdate", "l_tax", "o_orderdate", "o_orderpriority"):
        assert unused not in text
