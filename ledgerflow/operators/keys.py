"""Billing-key numbering (``EDGE-0001`` ...) per study and scenario.

Keys are numbered over *distinct keys*, never over lines: special-sheet keys
(sheet, activity, row, staff group, arm) first, by first appearance, then
arm keys (arm, visit) continuing the count.  First appearance follows the
source's line order: UA/Setup lines first, then all others, each by
(row_id, line type).

A dense 1..n sequence inside one study needs an order, and one study may
hold a large share of all keys.  ``dense_sequence`` therefore numbers keys
inside bounded buckets of the order key and adds the bucket's offset taken
from a small table of bucket counts: no task ever sorts more than
``bucket_size`` keys, and no global ``Window`` without partition is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.nulls import is_in
from ledgerflow.functions.text import edge_key
from ledgerflow.operators.allocate import ADJUSTMENT_SPECIAL, PHARMACY, join_null_safe

# The special sheets (excluded from arm processing).
SPECIAL_SHEETS = ("Unscheduled Activities", "Setup & Closedown", "Pharmacy")

SPECIAL_KEY = ("sheet_name", "activity", "row_id", "staff_group", "study_arm")
MAIN_KEY = ("study_arm", "visit")


def dense_sequence(df: DataFrame, *, partition_cols: Sequence[str], order_cols: Sequence[str],
                   bucket_col: str, out_col: str, nulls: bool = True, weight_col: str | None = None,
                   single: bool = False, facts: tuple[DataFrame, Sequence[str]] | None = None) -> DataFrame:
    """1..n per partition in ``order_cols`` order; ``bucket_col`` must be a
    coarse, order-preserving function of the order (a prefix of it).
    ``nulls=False``: partition and bucket columns are never NULL.
    ``single``: no partition has more rows than a bucket, so no offsets are counted.
    ``facts``: a small table and the partition columns that key it; its other
    columns reach the rows with the offsets (not with ``single``).

    With ``weight_col`` a row stands for so many numbers, and gets the count
    of those before it: rows that are going to be multiplied are numbered
    before they are, so a bucket holds no more rows than its order keys."""
    p = list(partition_cols)
    # One column that is never NULL stands for keys that may be, so that the window, the counts and the join share a deal.
    keys, part = p + [bucket_col], lambda c: F.col(c)
    if nulls and not single:
        df, keys, part = df.withColumn("__key", F.struct(*keys)), ["__key"], lambda c: F.col(f"__key.{c}")
    inside = Window.partitionBy(*(p if single else keys)).orderBy(*order_cols)
    if weight_col is None:
        rank, size = F.row_number().over(inside), F.count(F.lit(1))
    else:
        earlier = F.sum(weight_col).over(inside.rowsBetween(Window.unboundedPreceding, -1))
        rank, size = F.coalesce(earlier, F.lit(0)), F.sum(weight_col)
    local = df.withColumn("__local", rank)
    if single:
        return local.withColumn(out_col, F.col("__local").cast("long")).drop("__local")
    counts = df.groupBy(*keys).agg(size.alias("__cnt"))
    before = Window.partitionBy(*[part(c) for c in p]).orderBy(part(bucket_col)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(before), F.lit(0))).drop("__cnt")
    if facts is not None:
        about, by = facts
        named = {f"__by_{c}": part(c) for c in by}
        about = about.withColumnsRenamed({c: f"__by_{c}" for c in by})
        offsets = join_null_safe(offsets.withColumns(named), about, list(named), "left", nulls).drop(*named)
    return (local.join(offsets, keys)
            .withColumn(out_col, (F.col("__off") + F.col("__local")).cast("long"))
            .drop("__key", "__off", "__local"))


def key_table(adjusted: DataFrame, *, study_cols: Sequence[str] = ("cpms_id", "scenario_id"),
              bucket_size: int = 1_000_000, single: bool = False) -> DataFrame:
    """Distinct keys with their number and ``edge_key`` text.
    ``single``: no study has more keys than a bucket.

    Columns: study cols, ``key_class`` ('special'/'main'), the five special
    key columns (NULL where not applicable), ``has_sheet`` (some line of the
    key names its sheet), ``edge_seq``, ``edge_key``.
    """
    s = list(study_cols)
    sheet = F.col("sheet_name")
    special = is_in(sheet, SPECIAL_SHEETS)
    part = F.when(is_in(sheet, ADJUSTMENT_SPECIAL), F.lit(0)).otherwise(F.lit(1))
    spec = (adjusted.filter(special)
            .groupBy(*s, *SPECIAL_KEY)
            .agg(F.min(F.struct(part.alias("part"), F.col("row_id"))).alias("first"))
            .select(*s, F.lit("special").alias("key_class"), *SPECIAL_KEY, F.lit(True).alias("has_sheet"),
                    F.lit(0).alias("cls"), F.col("first.part").alias("part"), F.col("first.row_id").alias("first_row")))
    main = (adjusted.filter(~special)
            .groupBy(*s, *MAIN_KEY)
            .agg(F.min("row_id").alias("first_row"), F.max(sheet.isNotNull()).alias("has_sheet"))
            .select(*s, F.lit("main").alias("key_class"), F.lit(None).cast("string").alias("sheet_name"),
                    F.lit(None).cast("string").alias("activity"), F.lit(None).cast("long").alias("row_id"),
                    F.lit(None).cast("int").alias("staff_group"), "study_arm", "has_sheet",
                    F.lit(1).alias("cls"), F.lit(1).alias("part"), "first_row",
                    F.col("visit").alias("key_visit")))
    spec = spec.withColumn("key_visit", F.lit(None).cast("string"))
    keys = spec.unionByName(main)
    bucket = F.struct("cls", "part", F.floor(F.col("first_row") / F.lit(bucket_size)).alias("b"))
    numbered = dense_sequence(keys.withColumn("__bucket", bucket), partition_cols=s,
                              order_cols=["cls", "part", "first_row", "key_visit", "study_arm"],
                              bucket_col="__bucket", out_col="edge_seq", single=single)
    return (numbered.withColumn("edge_key", edge_key("edge_seq"))
            .drop("__bucket", "cls", "part", "first_row"))


def assign_edge_keys(adjusted: DataFrame, *, study_cols: Sequence[str] = ("cpms_id", "scenario_id"),
                     bucket_size: int = 1_000_000, keys: DataFrame | None = None, known: Sequence[str] = ()) -> DataFrame:
    """Every line gets its special key, else its arm/visit key.
    ``keys``: the key table, where it is stored; ``known``: key columns that
    are never NULL in ``adjusted``."""
    s = list(study_cols)
    keys = keys if keys is not None else key_table(adjusted, study_cols=s, bucket_size=bucket_size)
    spec = (keys.filter(F.col("key_class") == "special")
            .select(*s, *SPECIAL_KEY, F.col("edge_key").alias("__k1")))
    main = (keys.filter(F.col("key_class") == "main")
            .select(*s, "study_arm", F.col("key_visit").alias("visit"), F.col("edge_key").alias("__k2")))
    out = join_null_safe(adjusted, spec, s + list(SPECIAL_KEY), "left", known=known)
    out = join_null_safe(out, main, s + list(MAIN_KEY), "left", known=known)
    return out.withColumn("edge_key", F.coalesce("__k1", "__k2")).drop("__k1", "__k2")


__all__ = ["SPECIAL_SHEETS", "PHARMACY", "dense_sequence", "key_table", "assign_edge_keys"]
