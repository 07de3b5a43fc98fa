"""Proportional allocation with a penny-exact residual (the flagship operator).

Per group ``g`` of posting lines, ordered by ``order_cols`` then line type:

    contract_price = round_half_even(first(contract_cost), 0)
    base_sum       = sum(amount), 0 when every amount is NULL
    multiplier     = NULL if base_sum = 0 else contract_price / base_sum
    adjusted       = 0 if base_sum = 0 else round_half_even(amount * multiplier, 2)
    residual       = round(contract_price - sum(adjusted), 2)
    target row     = first DIRECT line, else first line; exactly one line,
                     among equal keys one with the least amount
    adjusted[target] += residual
    adjusted_sum_check = sum(final adjusted), diff_check = price - that sum

Two physical strategies compute the same result:

``method="window"``
    window aggregates over one partition spec: one shuffle of the lines on
    the group key and one sort.  For groups that stay small whatever the
    data's size (the lines of one order, say).

``method="agg"`` (skew-safe)
    the lines are written once, each with a number of its own. One aggregate
    with map-side combine gives every group's statistics, its target line
    among them as a least (order, amount, number). Groups above the bound
    are split: their lines meet the statistics row where they are, their
    rounded amounts are summed map-side, and the residual goes to the line
    whose number is the target's, so lines that tie on every key are dealt
    like any others. All other groups take the window form. The bound is
    ``rows_per_task`` lines, or one in ``SPLIT_GROUPS`` of all lines where
    that is more, so at most ``SPLIT_GROUPS`` statistics rows are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.nulls import AMOUNT, MONEY, WIDE_AMOUNT

ALLOC_COLUMNS = ("contract_price", "base_sum", "multiplier", "adjusted_amount", "residual",
                 "is_residual_row", "adjusted_sum_check", "diff_check")

# Fixed value: the line type that absorbs the rounding residual.
RESIDUAL_TYPE = "DIRECT"

_P = "__alloc_"  # prefix of private columns

#: Groups whose lines are spread over tasks: at most so many.
SPLIT_GROUPS = 10_000


def _order_struct(order_cols: Sequence[str], type_col: str) -> Column:
    return F.struct(*[F.col(c) for c in order_cols], F.col(type_col))


def _target_struct(order_cols: Sequence[str], type_col: str, residual_type: str) -> Column:
    not_target_type = F.coalesce(F.col(type_col) != F.lit(residual_type), F.lit(True))
    return F.struct(not_target_type.alias("nd"), *[F.col(c) for c in order_cols], F.col(type_col))


def _prepare(df: DataFrame, amount_col: str, cost_col: str, order_cols, type_col, residual_type) -> DataFrame:
    return (df
            .withColumn(f"{_P}amt", F.col(amount_col).cast(AMOUNT))
            .withColumn(f"{_P}price", F.bround(F.col(cost_col).cast("decimal(20,6)"), 0).cast(MONEY))
            .withColumn(f"{_P}ord", _order_struct(order_cols, type_col))
            .withColumn(f"{_P}tgt", _target_struct(order_cols, type_col, residual_type)))


def _adjusted(amount: Column, base_sum: Column, multiplier: Column) -> Column:
    scaled = (amount.cast("double") * multiplier).cast(AMOUNT)
    return F.when(base_sum == 0, F.lit(0).cast(MONEY)).otherwise(F.bround(scaled, 2).cast(MONEY))


def _multiplier(price: Column, base_sum: Column) -> Column:
    return F.when(base_sum == 0, F.lit(None).cast("double")) \
        .otherwise(price.cast("double") / base_sum.cast("double"))


def _allocate_window(df: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*group_cols)
    first = w.orderBy(f"{_P}tgt", F.col(f"{_P}amt").asc_nulls_last())
    # One select per step, so each step is a single Window operator over the
    # same partitioning (one exchange for the whole allocation).
    step1 = df.select("*", (F.row_number().over(first) == 1).alias("is_residual_row"))
    step1 = step1.select(
        "*",
        F.min_by(f"{_P}price", f"{_P}ord").over(w).alias("contract_price"),
        F.coalesce(F.sum(f"{_P}amt").over(w), F.lit(0)).cast(WIDE_AMOUNT).alias("base_sum"))
    step1 = (step1.withColumn("multiplier", _multiplier(F.col("contract_price"), F.col("base_sum")))
             .withColumn("adjusted_amount", _adjusted(F.col(f"{_P}amt"), F.col("base_sum"), F.col("multiplier"))))
    step2 = step1.select("*", F.sum("adjusted_amount").over(w).alias(f"{_P}adj_sum"))
    residual = F.bround(F.col("contract_price") - F.coalesce(f"{_P}adj_sum", F.lit(0)), 2).cast(MONEY)
    step2 = (step2.withColumn("residual", residual)
             .withColumn("adjusted_amount", F.when(F.col("is_residual_row"), F.bround(F.col("adjusted_amount") + F.col("residual"), 2).cast(MONEY))
                         .otherwise(F.col("adjusted_amount"))))
    return _checked(step2.select("*", F.sum("adjusted_amount").over(w).alias(f"{_P}final")))


def _checked(df: DataFrame) -> DataFrame:
    """Reconciliation from the sum of a group's final amounts."""
    return (df.withColumn("adjusted_sum_check", F.bround(F.coalesce(f"{_P}final", F.lit(0)), 2).cast(MONEY))
            .withColumn("diff_check", F.bround(F.col("contract_price") - F.col("adjusted_sum_check"), 2).cast(MONEY)))


def _allocate_agg(df: DataFrame, group_cols: Sequence[str], rows_per_task: int, dealt_by: str | None = None) -> DataFrame:
    from ledgerflow.sources.stage import materialize, stored_as_dealt

    g = list(group_cols)
    store = materialize if dealt_by is None else lambda rows, name: stored_as_dealt(rows, name, dealt_by)
    lines = store(df.withColumn(f"{_P}line", F.monotonically_increasing_id()), "alloc_lines")
    amount = F.col(f"{_P}amt")
    target = F.min(F.struct(f"{_P}tgt", amount.isNull(), amount, f"{_P}line"))
    stats = store(lines.groupBy(*g).agg(
        F.count(F.lit(1)).alias(f"{_P}n"),
        F.coalesce(F.sum(amount), F.lit(0)).cast(WIDE_AMOUNT).alias("base_sum"),
        F.min_by(f"{_P}price", f"{_P}ord").alias("contract_price"),
        target[f"{_P}line"].alias(f"{_P}target")), "alloc_groups")
    total = stats.agg(F.coalesce(F.sum(f"{_P}n"), F.lit(0))).first()[0]
    large = F.col(f"{_P}n") > F.lit(max(rows_per_task, total // SPLIT_GROUPS))
    split = stats.filter(large).drop(f"{_P}n").withColumn("multiplier", _multiplier(F.col("contract_price"), F.col("base_sum")))
    if split.isEmpty():
        return _allocate_window(lines, g)

    def with_stats(per_group: DataFrame) -> DataFrame:
        met = join_null_safe(lines, F.broadcast(per_group), g, "inner")
        return (met.withColumn("adjusted_amount", _adjusted(amount, F.col("base_sum"), F.col("multiplier")))
                .withColumn("is_residual_row", F.col(f"{_P}line") == F.col(f"{_P}target")))

    sums = materialize(with_stats(split).groupBy(*g).agg(
        F.sum("adjusted_amount").alias(f"{_P}adj_sum"),
        F.min(F.when(F.col("is_residual_row"), F.col("adjusted_amount"))).alias(f"{_P}tgt_adj")), "alloc_sums")
    residual = F.bround(F.col("contract_price") - F.coalesce(f"{_P}adj_sum", F.lit(0)), 2).cast(MONEY)
    changed = F.bround(F.col(f"{_P}tgt_adj") + F.col("residual"), 2).cast(MONEY)
    # The group's final sum: its rounded sum, with the one target line exchanged.
    final = F.coalesce(f"{_P}adj_sum", F.lit(0)) - F.coalesce(f"{_P}tgt_adj", F.lit(0)) + F.coalesce(changed, F.lit(0))
    whole = join_null_safe(split, sums, g, "inner").withColumn("residual", residual)
    out = with_stats(whole.withColumn(f"{_P}changed", changed).withColumn(f"{_P}final", final))
    out = _checked(out.withColumn("adjusted_amount", F.when(F.col("is_residual_row"), F.col(f"{_P}changed")).otherwise(F.col("adjusted_amount"))))
    rest = join_null_safe(lines, F.broadcast(split.select(*g)), g, "left_anti")
    return _allocate_window(rest, g).unionByName(out.drop(f"{_P}changed", f"{_P}target", f"{_P}tgt_adj"), allowMissingColumns=False)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, nulls: bool = True,
                   known: Sequence[str] = ()) -> DataFrame:
    """Join on ``keys`` where NULL matches NULL; keeps the left key columns only.

    ``nulls=False`` is for keys that are never NULL: plain equality, which can
    use a partitioning that the keys already have.  ``known``: the keys of which
    that holds, where it does not for all."""
    if not nulls:
        return left.join(right, on=list(keys), how=how)
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"{_P}r_{k}")
    cond = None
    for k in keys:
        theirs = F.col(f"{_P}r_{k}")
        c = F.col(k) == theirs if k in known else F.col(k).eqNullSafe(theirs)
        cond = c if cond is None else cond & c
    return left.join(renamed, on=cond, how=how).drop(*[f"{_P}r_{k}" for k in keys])


def allocate(df: DataFrame, *, group_cols: Sequence[str], order_cols: Sequence[str],
             amount_col: str = "posting_amount", cost_col: str = "contract_cost",
             type_col: str = "posting_line_type_id", method: str = "window",
             rows_per_task: int = 2_000_000, residual_type: str = RESIDUAL_TYPE,
             dealt_by: str | None = None) -> DataFrame:
    """Scale every group's lines so they sum to its rounded contract price.

    ``group_cols`` should lead with the study key so groups of different
    studies never mix.  Adds the columns of ``ALLOC_COLUMNS``.  ``dealt_by``:
    the one of ``group_cols`` that ``df`` is dealt by (``sources.stage``) and
    never NULL in; what is stored stays so.
    """
    if method not in ("window", "agg"):
        raise ValueError(f"unknown allocation method {method!r}")
    existing = [c for c in ALLOC_COLUMNS if c in df.columns]
    base = df.drop(*existing) if existing else df
    prepared = _prepare(base, amount_col, cost_col, order_cols, type_col, residual_type)
    out = (_allocate_window(prepared, group_cols) if method == "window"
           else _allocate_agg(prepared, group_cols, rows_per_task, dealt_by))
    return out.select(*base.columns, *ALLOC_COLUMNS)


# Sheets balanced per activity rather than per visit.
ADJUSTMENT_SPECIAL = ("Unscheduled Activities", "Setup & Closedown")
PHARMACY = "Pharmacy"


def with_alloc_key(df: DataFrame, *, sheet_col: str = "sheet_name", arm_col: str = "study_arm",
                   row_col: str = "row_id", activity_col: str = "activity",
                   staff_col: str = "staff_group", visit_col: str = "visit") -> DataFrame:
    """One composite group key for both sheet classes (no filter + union of two plans).

    UA and Setup sheets balance per (row, activity, staff group); every other
    sheet per (pool, visit), where Pharmacy lines pool with their arm.
    """
    from ledgerflow.functions.nulls import is_in, trim_ws

    special = is_in(sheet_col, ADJUSTMENT_SPECIAL)
    pool = trim_ws(F.when(F.col(sheet_col) == PHARMACY, F.col(arm_col)).otherwise(F.col(sheet_col)))
    return (df
            .withColumn("alloc_class", F.when(special, F.lit("activity")).otherwise(F.lit("visit")))
            .withColumn("alloc_key", F.when(
                special,
                F.struct(F.col(row_col).cast("string").alias("a"), F.col(activity_col).alias("b"),
                         F.col(staff_col).cast("string").alias("c")))
                .otherwise(F.struct(pool.alias("a"), F.col(visit_col).alias("b"),
                                    F.lit(None).cast("string").alias("c")))))


def adjust_posting_lines(plan: DataFrame, *, study_col: str = "cpms_id", method: str = "agg",
                         rows_per_task: int = 2_000_000, order_cols: Sequence[str] = ("row_id",),
                         grain: str = "sheet", dealt_by: str | None = None) -> DataFrame:
    """Allocation of a posting plan, grouped the way each sheet class needs.

    ``grain="sheet"`` is the live grouping; ``grain="row"`` balances every
    source row alone per scenario (the older grouping).  Pools of a visit
    grow with the data, so the splitting method is the default.
    """
    if grain == "row":
        return allocate(plan, group_cols=[study_col, "scenario_id", "row_id"], order_cols=list(order_cols),
                        method=method, rows_per_task=rows_per_task, dealt_by=dealt_by)
    keyed = with_alloc_key(plan)
    out = allocate(keyed, group_cols=[study_col, "scenario_id", "alloc_class", "alloc_key"],
                   order_cols=list(order_cols), method=method, rows_per_task=rows_per_task, dealt_by=dealt_by)
    return out.drop("alloc_class", "alloc_key")
