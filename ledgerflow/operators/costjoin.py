"""Two-level contract-cost join (activity level, then visit level).

Activity-level cost rows are keyed by (study, source sheet, visit, arm,
activity, staff group) and reduced to one row per key before the join, so
the join never multiplies rows; ``compat=True`` reproduces the source's
five-key join without the sheet and without reduction, of activity and of
visit costs (it fans out when a key repeats -- see ``cost_dup_audit``).  Visit-level summary rows are the
fallback, keyed by (study, visit, arm).

The cost table has one row per study x visit x arm (x activity), so it
grows with the number of studies; the joins are left shuffle joins that
AQE turns into broadcasts when the runtime size is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.allocate import join_null_safe

ACTIVITY_KEYS = (("cpms_id", "cpms_id"), ("source_sheet", "source_sheet"), ("visit", "visit_number"),
                 ("study_arm", "study_arm"), ("activity", "activity_name"), ("staff_group", "staff_group"))
VISIT_KEYS = (("cpms_id", "cpms_id"), ("visit", "visit_number"), ("study_arm", "study_arm"))


def _keys(compat: bool, sheet_col: str):
    if compat:
        return tuple(p for p in ACTIVITY_KEYS if p[0] != "source_sheet")
    return tuple((sheet_col if a == "source_sheet" else a, b) for a, b in ACTIVITY_KEYS)


def activity_costs(cost_table: DataFrame, *, compat: bool = False, sheet_col: str = "source_sheet") -> DataFrame:
    keys = _keys(compat, sheet_col)
    act = cost_table.filter(F.col("activity_name").isNotNull())
    rename = [F.col(b).alias(a) for a, b in keys]
    if compat:
        return act.select(*rename, F.col("ict_cost").alias("contract_cost_activity"),
                          F.col("activity_occurrence_id").alias("cost_occurrence_id"))
    return (act.select(*rename, "ict_cost")
            .groupBy(*[a for a, _ in keys])
            .agg(F.max("ict_cost").alias("contract_cost_activity")))


def visit_costs(cost_table: DataFrame, *, compat: bool = False) -> DataFrame:
    rows = (cost_table.filter(F.col("activity_name").isNull())
            .select(*[F.col(b).alias(a) for a, b in VISIT_KEYS], "ict_cost"))
    if compat:
        return rows.withColumnRenamed("ict_cost", "contract_cost_visit")
    return (rows.groupBy(*[a for a, _ in VISIT_KEYS])
            .agg(F.max("ict_cost").alias("contract_cost_visit")))


def join_activity_costs(df: DataFrame, cost_table: DataFrame, *, compat: bool = False,
                        sheet_col: str = "source_sheet", known: Sequence[str] = ()) -> DataFrame:
    act = activity_costs(cost_table, compat=compat, sheet_col=sheet_col)
    out = join_null_safe(df, act, [a for a, _ in _keys(compat, sheet_col)], "left", known=known)
    return out.drop("cost_occurrence_id") if compat else out


def join_visit_costs(df: DataFrame, cost_table: DataFrame, *, compat: bool = False, known: Sequence[str] = ()) -> DataFrame:
    return join_null_safe(df, visit_costs(cost_table, compat=compat), [a for a, _ in VISIT_KEYS], "left", known=known)


def join_ict_costs(df: DataFrame, cost_table: DataFrame | None, *, compat: bool = False,
                   sheet_col: str = "source_sheet", known: Sequence[str] = ()) -> DataFrame:
    """Attach ``contract_cost``: activity cost, else visit cost, else NULL.

    A missing cost table (``None``) gives a NULL ``contract_cost`` column.
    ``known``: key columns that are never NULL in ``df``.
    """
    if cost_table is None:
        return df.withColumn("contract_cost", F.lit(None).cast("decimal(18,2)"))
    out = join_activity_costs(df, cost_table, compat=compat, sheet_col=sheet_col, known=known)
    out = join_visit_costs(out, cost_table, compat=compat, known=known)
    return (out.withColumn("contract_cost", F.coalesce("contract_cost_activity", "contract_cost_visit"))
            .drop("contract_cost_activity", "contract_cost_visit"))


def cost_dup_audit(cost_table: DataFrame) -> DataFrame:
    """Q5: activity keys that repeat under the source's five-key join."""
    keys = [b for a, b in ACTIVITY_KEYS if a != "source_sheet"]
    return (cost_table.filter(F.col("activity_name").isNotNull())
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("ict_cost").alias("n_costs"))
            .filter(F.col("n_rows") > 1))


def label_lookup(cost_table: DataFrame) -> DataFrame:
    """Distinct (arm, visit) -> label pairs from the cost table."""
    return (cost_table.select("cpms_id", F.col("study_arm"), F.col("visit_number").alias("visit"),
                              F.col("visit_label").alias("cost_visit_label"))
            .groupBy("cpms_id", "study_arm", "visit")
            .agg(F.min("cost_visit_label").alias("cost_visit_label")))


def enrich_labels(df: DataFrame, cost_table: DataFrame, *, label_source: str = "cost", known: Sequence[str] = ()) -> DataFrame:
    """Take the visit label from the cost table, falling back to the visit.

    ``label_source="visit"`` keeps the live behaviour (label = visit).
    """
    if label_source == "visit":
        return df.withColumn("visit_label", F.col("visit"))
    out = join_null_safe(df, label_lookup(cost_table), ["cpms_id", "study_arm", "visit"], "left", known=known)
    return (out.withColumn("visit_label", F.coalesce("cost_visit_label", "visit"))
            .drop("cost_visit_label"))
