"""Allocation queries on ``orders`` x ``lineitem``.

Each order is a group (study = customer): its rounded total price is split
over its lines in proportion to their extended price, and the rounding
residual lands on the first DIRECT line (line type from the return flag).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.nulls import AMOUNT
from ledgerflow.operators.allocate import ALLOC_COLUMNS, allocate
from ledgerflow.plans.registry import register

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]  # total order within an order
GROUP = ["o_custkey", "l_orderkey"]
KEY_COLS = GROUP + LINE_ORDER[:3] + ["posting_line_type_id"]

# Line type per return flag (invented for the driver tables).
LINE_TYPE_SQL = ("CASE l_returnflag WHEN 'N' THEN 'DIRECT' WHEN 'A' THEN 'OVERHEAD' "
                 "ELSE 'SUPPORT' END")


def order_lines(spark: SparkSession, sf_dir: str, *, zero_status: str | None = None,
                null_priority: str | None = None, null_amount_discount: float | None = None) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    amount = F.col("l_extendedprice").cast(AMOUNT)
    if zero_status is not None:
        amount = F.when(F.col("o_orderstatus") == zero_status, F.lit(0).cast(AMOUNT)).otherwise(amount)
    if null_amount_discount is not None:
        amount = F.when(F.col("l_discount") == null_amount_discount, F.lit(None).cast(AMOUNT)).otherwise(amount)
    cost = F.col("o_totalprice")
    if null_priority is not None:
        cost = F.when(F.col("o_orderpriority") == null_priority, F.lit(None).cast("double")).otherwise(cost)
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select("o_custkey", "l_orderkey", *LINE_ORDER,
                    F.expr(LINE_TYPE_SQL).alias("posting_line_type_id"),
                    amount.alias("posting_amount"), cost.alias("contract_cost")))


def _alloc(spark, sf_dir, method="window", **kw) -> DataFrame:
    lines = order_lines(spark, sf_dir, **kw)
    out = allocate(lines, group_cols=GROUP, order_cols=LINE_ORDER, method=method)
    return out.select(*KEY_COLS, "posting_amount", *ALLOC_COLUMNS)


# ---------------------------------------------------------------------------
# Oracle: grouped subqueries and arg_min, no window functions.

def _oracle_lines(amount="CAST(l_extendedprice AS DECIMAL(18,6))", cost="o_totalprice") -> str:
    return f"""
lines AS (
  SELECT o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         {LINE_TYPE_SQL} AS posting_line_type_id,
         {amount} AS posting_amount, {cost} AS contract_cost
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def alloc_oracle(lines_cte: str, group: list[str], order: list[str], src: str = "lines",
                 drop: tuple[str, ...] = ("contract_cost",)) -> str:
    """Independent SQL of the allocation over the CTE ``src``.

    ``lines_cte`` is either bare CTE text or a full ``WITH ...`` chain.
    """
    gk = ", ".join(group)
    ordt = "(" + ", ".join(order + ["posting_line_type_id"]) + ")"
    tgt_ord = "(CASE WHEN posting_line_type_id = 'DIRECT' THEN 0 ELSE 1 END, " + ", ".join(
        order + ["posting_line_type_id"]) + ")"
    join_on = " AND ".join(f"l.{c} IS NOT DISTINCT FROM g.{c}" for c in group)
    join_on2 = " AND ".join(f"b.{c} IS NOT DISTINCT FROM r.{c}" for c in group)
    join_on3 = " AND ".join(f"c.{c} IS NOT DISTINCT FROM s.{c}" for c in group)
    head = lines_cte.strip()
    head = head if head.upper().startswith("WITH") else "WITH " + head
    return f"""{head},
g AS (
  SELECT {gk},
         CAST(COALESCE(SUM(posting_amount), 0) AS DECIMAL(28,6)) AS base_sum,
         CAST(round_even(arg_min_null(CAST(contract_cost AS DECIMAL(20,6)), {ordt}), 0) AS DECIMAL(18,2)) AS contract_price
  FROM {src} GROUP BY {gk}),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {gk} ORDER BY {tgt_ord}, posting_amount NULLS LAST) = 1 AS is_residual_row
  FROM {src}),
a AS (
  SELECT l.* EXCLUDE (is_residual_row), g.contract_price, g.base_sum,
         CASE WHEN g.base_sum = 0 THEN NULL ELSE CAST(g.contract_price AS DOUBLE) / CAST(g.base_sum AS DOUBLE) END AS multiplier,
         l.is_residual_row
  FROM numbered l JOIN g ON {join_on}),
b AS (
  SELECT *, CASE WHEN base_sum = 0 THEN CAST(0 AS DECIMAL(18,2))
                 ELSE CAST(round_even(CAST(CAST(posting_amount AS DOUBLE) * multiplier AS DECIMAL(18,6)), 2) AS DECIMAL(18,2)) END AS adj0
  FROM a),
r AS (
  SELECT {gk}, CAST(round_even(MAX(contract_price) - COALESCE(SUM(adj0), 0), 2) AS DECIMAL(18,2)) AS residual
  FROM b GROUP BY {gk}),
c AS (
  SELECT b.*, r.residual,
         CASE WHEN b.is_residual_row THEN CAST(round_even(b.adj0 + r.residual, 2) AS DECIMAL(18,2)) ELSE b.adj0 END AS adjusted_amount
  FROM b JOIN r ON {join_on2}),
s AS (
  SELECT {gk}, CAST(round_even(COALESCE(SUM(adjusted_amount), 0), 2) AS DECIMAL(18,2)) AS adjusted_sum_check
  FROM c GROUP BY {gk})
SELECT c.* EXCLUDE ({", ".join(("adj0",) + tuple(drop))}), s.adjusted_sum_check,
       CAST(round_even(c.contract_price - s.adjusted_sum_check, 2) AS DECIMAL(18,2)) AS diff_check
FROM c JOIN s ON {join_on3}"""


_DROP = ("contract_cost", "l_extendedprice")
_ALLOC_SQL = alloc_oracle(_oracle_lines(), GROUP, LINE_ORDER, drop=_DROP)


@register("alloc_window", _ALLOC_SQL)
def alloc_window(spark, sf_dir):
    return _alloc(spark, sf_dir, method="window")


@register("alloc_agg", _ALLOC_SQL)
def alloc_agg(spark, sf_dir):
    return _alloc(spark, sf_dir, method="agg")


@register("alloc_zero_base", alloc_oracle(_oracle_lines(
    amount="CASE WHEN o_orderstatus = 'F' THEN CAST(0 AS DECIMAL(18,6)) ELSE CAST(l_extendedprice AS DECIMAL(18,6)) END"),
    GROUP, LINE_ORDER, drop=_DROP))
def alloc_zero_base(spark, sf_dir):
    """Orders with status F have all-zero amounts: the whole price goes to the target line."""
    return _alloc(spark, sf_dir, zero_status="F")


@register("alloc_null_price", alloc_oracle(_oracle_lines(
    amount="CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,6)) END",
    cost="CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END"), GROUP, LINE_ORDER, drop=_DROP))
def alloc_null_price(spark, sf_dir):
    """NULL prices (5-LOW orders) and NULL amounts (zero discount) in one run."""
    return _alloc(spark, sf_dir, null_priority="5-LOW", null_amount_discount=0.0)


@register("alloc_residual_rows", f"""SELECT o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, posting_line_type_id,
       residual, adjusted_amount FROM ({_ALLOC_SQL}) q WHERE is_residual_row""")
def alloc_residual_rows(spark, sf_dir):
    """The one line per order that absorbed the rounding residual."""
    out = _alloc(spark, sf_dir, method="window")
    return out.filter("is_residual_row").select(*KEY_COLS, "residual", "adjusted_amount")


@register("balance_audit", f"""SELECT o_custkey,
       CAST(COUNT(DISTINCT l_orderkey) AS BIGINT) AS n_groups,
       CAST(COUNT(DISTINCT CASE WHEN diff_check IS NULL OR diff_check <> 0 THEN l_orderkey END) AS BIGINT) AS n_unbalanced,
       CAST(SUM(adjusted_amount) AS DECIMAL(18,2)) AS total_adjusted,
       CAST(SUM(CASE WHEN is_residual_row THEN contract_price END) AS DECIMAL(18,2)) AS total_price
FROM ({_ALLOC_SQL}) q GROUP BY o_custkey""")
def balance_audit(spark, sf_dir):
    """Per study: groups, groups whose lines do not sum to the price, totals."""
    from ledgerflow.operators.quality import balance_audit as audit
    out = _alloc(spark, sf_dir, method="window")
    return audit(out, study_cols=["o_custkey"], group_cols=["l_orderkey"])


# ---------------------------------------------------------------------------
# Ties: the line number is left out of the order and every line is equal in
# its keys to the other lines of its order, part and type.
TIED_GROUP = ["o_custkey"]
TIED_ORDER = ["l_orderkey"]
_TIED_LINES = """lines AS (
  SELECT o_custkey, l_orderkey, l_linenumber, """ + LINE_TYPE_SQL + """ AS posting_line_type_id,
         CAST(100 AS DECIMAL(18,6)) AS posting_amount, o_totalprice AS contract_cost
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_TIED_SQL = f"""SELECT o_custkey, l_orderkey, posting_line_type_id, adjusted_amount, residual, adjusted_sum_check, diff_check,
       CAST(COUNT(*) AS BIGINT) AS n_lines, CAST(SUM(CASE WHEN is_residual_row THEN 1 ELSE 0 END) AS BIGINT) AS n_residual
FROM ({alloc_oracle(_TIED_LINES, TIED_GROUP, TIED_ORDER)}) q GROUP BY ALL"""


def _tied(spark, sf_dir, method) -> DataFrame:
    lines = order_lines(spark, sf_dir).withColumn("posting_amount", F.lit(100).cast(AMOUNT))
    out = allocate(lines, group_cols=TIED_GROUP, order_cols=TIED_ORDER, method=method)
    return out.groupBy("o_custkey", "l_orderkey", "posting_line_type_id", "adjusted_amount", "residual", "adjusted_sum_check", "diff_check").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("is_residual_row").cast("long")).alias("n_residual"))


@register("alloc_tied_lines", _TIED_SQL)
def alloc_tied_lines(spark, sf_dir):
    """Lines that tie on every order key: one of them takes the residual."""
    return _tied(spark, sf_dir, "window")


@register("alloc_tied_lines_agg", _TIED_SQL)
def alloc_tied_lines_agg(spark, sf_dir):
    return _tied(spark, sf_dir, "agg")


# ---------------------------------------------------------------------------
# Skew: every line of a finished order (status F, about half of all lines)
# falls into ONE allocation group; the others stay one group per order.

SKEW_GROUP_SQL = "CASE WHEN o_orderstatus = 'F' THEN CAST(-1 AS BIGINT) ELSE l_orderkey END"
SKEW_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
SKEW_ROWS_PER_TASK = 10_000  # small enough that the hot group is split even at sf0.01


def _skewed(spark, sf_dir, method):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = (li.join(o, li.l_orderkey == o.o_orderkey)
             .select(F.expr(SKEW_GROUP_SQL).alias("alloc_group"), *SKEW_ORDER,
                     F.expr(LINE_TYPE_SQL).alias("posting_line_type_id"),
                     F.col("l_extendedprice").cast(AMOUNT).alias("posting_amount"),
                     F.col("o_totalprice").alias("contract_cost")))
    out = allocate(lines, group_cols=["alloc_group"], order_cols=SKEW_ORDER, method=method,
                   rows_per_task=SKEW_ROWS_PER_TASK)
    return out.select("alloc_group", *SKEW_ORDER[:4], "posting_line_type_id", "posting_amount", *ALLOC_COLUMNS)


_SKEW_SQL = alloc_oracle(f"""
lines AS (
  SELECT {SKEW_GROUP_SQL} AS alloc_group, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         {LINE_TYPE_SQL} AS posting_line_type_id,
         CAST(l_extendedprice AS DECIMAL(18,6)) AS posting_amount, o_totalprice AS contract_cost
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""", ["alloc_group"], SKEW_ORDER, drop=_DROP)


@register("alloc_skewed_window", _SKEW_SQL)
def alloc_skewed_window(spark, sf_dir):
    return _skewed(spark, sf_dir, "window")


@register("alloc_skewed_agg", _SKEW_SQL)
def alloc_skewed_agg(spark, sf_dir):
    """The hot group is split into salt buckets of ~10k lines across tasks."""
    return _skewed(spark, sf_dir, "agg")
