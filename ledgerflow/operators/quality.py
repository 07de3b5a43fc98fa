"""Data-quality audits.  Each returns a DataFrame of findings; only the
``strict`` helpers run an action (a bounded ``limit``) and raise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.nulls import MONEY


def balance_audit(adjusted: DataFrame, *, study_cols: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    """Per study: groups, unbalanced groups (the summed adjusted amounts are
    not the group's price), money totals.

    Two-stage aggregate (group, then study) so every step combines map-side.
    """
    per_group = adjusted.groupBy(*study_cols, *group_cols).agg(
        F.sum("adjusted_amount").alias("adj"),
        F.max("contract_price").alias("price"))
    per_group = per_group.withColumn("unbalanced", F.col("price").isNull() | (F.coalesce("adj", F.lit(0)) != F.col("price")))
    return per_group.groupBy(*study_cols).agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count(F.when(F.col("unbalanced"), 1)).alias("n_unbalanced"),
        F.sum("adj").cast(MONEY).alias("total_adjusted"),
        F.sum("price").cast(MONEY).alias("total_price"))


def or_fail(bad: Column, value: Column, message: str, *name_cols: str) -> Column:
    """``value``, or where ``bad`` holds an error that names the row's ``name_cols``."""
    names = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in name_cols])
    return F.when(~bad, value).otherwise(F.raise_error(F.concat(F.lit(message), names)))


def fail_if_any(findings: DataFrame, message: str, show: int = 20) -> None:
    """Strict mode: raise with up to ``show`` example rows if findings exist."""
    rows = findings.limit(show).collect()
    if rows:
        raise ValueError(f"{message}: " + "; ".join(str(r.asDict()) for r in rows))
