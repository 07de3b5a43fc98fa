"""Cost table from the grids: visit-level summary rows (transposed ``MFF``
row) and activity-level rows for the pseudo-arms (Setup, some-participant
and unscheduled rows), expanded one row per occurrence.

Output schema (the source's table plus ``source_sheet``)::

    cpms_id, study, visit_number, study_arm, visit_label, activity_name,
    ict_cost double, activity_occurrence_id int, staff_group int, source_sheet
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import visit_number
from ledgerflow.operators.allocate import join_null_safe
from ledgerflow.operators.grid import (ARM_SC, ARM_SSP, ARM_UA, FLAG_SETUP, FLAG_SOME, FLAG_UA, SHEET, SHEET_SETUP,
                                       MANY_SHEETS, SUMMARY_MARKER, coerce_mark, join_by_workbook)
from ledgerflow.operators.sequence import (DEFAULT_BUCKET, dense_sequence, largest_group, one_bucket, row_bucket, small_groups,
                                           with_copies)

COST_COLUMNS = ("cpms_id", "study", "visit_number", "study_arm", "visit_label", "activity_name", "ict_cost",
                "activity_occurrence_id", "staff_group", "source_sheet")

# Flag -> pseudo-arm of the activity-level cost rows.
PSEUDO_ARM_BY_FLAG = {FLAG_SETUP: ARM_SC, FLAG_SOME: ARM_SSP, FLAG_UA: ARM_UA}


def summary_rows(table: DataFrame) -> DataFrame:
    """First row per sheet whose cost cell contains the summary marker (raw, uncleaned rows)."""
    hit = F.coalesce(F.col("activity_cost").contains(SUMMARY_MARKER), F.lit(False))
    return (table.filter(hit).groupBy(*SHEET)
            .agg(F.min_by("marks", "row_idx").alias("summary_marks")))


def _per_sheet(layout: DataFrame, *facts: str) -> DataFrame:
    """A side of a join with a row per sheet.  It grows with the sheets and is
    never broadcast: Spark would go by its compressed file, a hundredth of its rows in memory."""
    return layout.select(*SHEET, *facts).hint("merge")


def summary_costs(table: DataFrame, layout: DataFrame) -> DataFrame:
    """R2: visit columns of the summary row to rows (visit-level cost rows)."""
    s = join_null_safe(summary_rows(table), _per_sheet(layout, "visit_names", "study_name", "cpms_id"), SHEET, "inner")
    ex = s.select("*", F.posexplode(F.arrays_zip(F.col("visit_names").alias("label"),
                                                 F.col("summary_marks").alias("mark"))).alias("p0", "vm"))
    arm = F.when(F.col("sheet_name") == SHEET_SETUP, F.lit(ARM_SC)).otherwise(F.col("sheet_name"))
    return ex.select(
        "cpms_id", F.col("study_name").alias("study"), visit_number(F.col("p0") + 1).alias("visit_number"),
        arm.alias("study_arm"), F.col("vm.label").alias("visit_label"),
        F.lit(None).cast("string").alias("activity_name"), F.col("vm.mark").try_cast("double").alias("ict_cost"),
        F.lit(None).cast("int").alias("activity_occurrence_id"), F.lit(None).cast("int").alias("staff_group"),
        F.col("sheet_name").alias("source_sheet"))


def label_lookup(table: DataFrame, layout: DataFrame) -> DataFrame:
    """Sheets with a summary row label visits by their column names."""
    return (summary_rows(table).select(*SHEET)
            .join(_per_sheet(layout, "visit_names"), SHEET, "inner")
            .withColumnRenamed("visit_names", "label_names"))


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def occurrence_totals(marks: Column) -> Column:
    """A1: total occurrences of a row: sum of marks, missing or 0 -> 1, half-even."""
    raw = _sum(F.transform(marks, coerce_mark))
    return F.bround(F.when(raw.isNull() | (raw == 0), F.lit(1.0)).otherwise(raw), 0)


def expand_cost_rows(clean: DataFrame, labels: DataFrame, bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """R3 + R4 + A2 + W3: activity-level cost rows of the pseudo-arm rows.

    Cost per occurrence = total cost / total occurrences; a row marked n
    times at a visit gives floor(n) rows there; a row without any mark gives
    one row at the first visit.  Occurrence ids count per (sheet, arm,
    visit, activity) across staff groups in row, visit, copy order.

    Rows that are dealt by workbook stay so where workbooks can be one task's,
    also where ``bucket_size`` numbers them over many buckets; those are then
    stored, as the numbering reads them twice.
    """
    from ledgerflow.sources.stage import is_dealt, stored_as_dealt

    arm = F.lit(None).cast("string")
    for flag, a in PSEUDO_ARM_BY_FLAG.items():
        arm = F.when(F.col("flag") == flag, F.lit(a)).otherwise(arm)
    rows = clean.filter(F.col("flag").isin(*PSEUDO_ARM_BY_FLAG)).withColumn("pseudo_arm", arm)
    most = largest_group(clean, "workbook_id") if small_groups(labels, "workbook_id", MANY_SHEETS) else None
    single = most is not None and most <= bucket_size
    stay = most is not None and most <= DEFAULT_BUCKET and is_dealt(clean, "workbook_id")
    rows = join_by_workbook(rows, labels, "left") if single or stay else join_null_safe(rows, labels, SHEET, "left")
    mk = F.transform(F.col("marks"), coerce_mark)
    filled = F.transform(mk, lambda x: F.coalesce(x, F.lit(0.0)))
    counts = F.when(_sum(filled) == 0,
                    F.transform(filled, lambda x, i: F.when(i == 0, F.lit(1.0)).otherwise(x))).otherwise(filled)
    total_cost = F.col("total_activity_cost").try_cast("double")
    per_visit = rows.select(
        "*", F.try_divide(total_cost, occurrence_totals(F.col("marks"))).alias("cost_per_occ"),
        F.posexplode(counts).alias("p0", "n"))
    per_visit = per_visit.withColumn("n_copies", F.floor("n").cast("int")).filter(F.col("n_copies") >= 1)
    vnum = visit_number(F.col("p0") + 1)
    label = F.coalesce(F.try_element_at(F.col("label_names"), (F.col("p0") + 1).cast("int")), vnum)
    shaped = per_visit.select(
        *SHEET, "row_idx", "p0", "n_copies", "cpms_id", F.col("study_name").alias("study"),
        vnum.alias("visit_number"), F.col("pseudo_arm").alias("study_arm"), label.alias("visit_label"),
        F.col("activity").alias("activity_name"), F.col("cost_per_occ").alias("ict_cost"), "staff_group",
        F.col("sheet_name").alias("source_sheet"), row_bucket("row_idx", bucket_size).alias("_b"))
    # Numbered before they are multiplied: a bucket has a row per row number at most.
    # Rows of ``clean`` have a workbook, a sheet and an activity (``grid.clean_rows``).
    whole = single or one_bucket(clean, "row_idx", bucket_size)
    numbered = dense_sequence(shaped, partition_cols=SHEET + ["study_arm", "visit_number", "activity_name"],
                              order_cols=["row_idx", "p0"], bucket_col="_b", out_col="occ", weight_col="n_copies", single=whole, nulls=False)
    if stay and not whole:
        numbered = stored_as_dealt(numbered.drop("row_idx", "p0", "_b"), "cost_rows_numbered", "workbook_id")
    copies = with_copies(numbered, "n_copies", "copy")
    return copies.withColumn("activity_occurrence_id", (F.col("occ") + F.col("copy")).cast("int")).select(*COST_COLUMNS)


def cost_table(table: DataFrame, layout: DataFrame, clean: DataFrame,
               bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """The full cost table of the grids (summary rows + pseudo-arm rows)."""
    return summary_costs(table, layout).unionByName(
        expand_cost_rows(clean, label_lookup(table, layout), bucket_size))


# ---------------------------------------------------------------------------
# K2 / K3: keyed upsert and NOT NULL audit

UPSERT_KEYS = ("cpms_id", "visit_number", "study_arm")
NOT_NULL_COLUMNS = ("cpms_id", "visit_number", "study_arm", "ict_cost")


def upsert(target: DataFrame, batch: DataFrame, keys=UPSERT_KEYS) -> DataFrame:
    """Delete target rows sharing a key with the batch, then add the batch."""
    batch_keys = batch.select(*keys).distinct()
    kept = join_null_safe(target, batch_keys.withColumn("_hit", F.lit(True)), list(keys), "left") \
        .filter(F.col("_hit").isNull()).drop("_hit")
    return kept.unionByName(batch.select(*target.columns))


def not_null_violations(costs: DataFrame, columns=NOT_NULL_COLUMNS) -> DataFrame:
    bad = None
    for c in columns:
        bad = F.col(c).isNull() if bad is None else bad | F.col(c).isNull()
    return costs.filter(bad)
