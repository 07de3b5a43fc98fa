"""Spreadsheet grids held as tables: metadata, header detection, naming,
cleaning, flag fill-forward and staff groups (stage A of the workbook
pipeline), all sheets of all workbooks in one DataFrame.

Input layout (one row per sheet row)::

    workbook_id string, sheet_name string, sheet_pos int, row_idx long,
    cells array<string>

Per-sheet facts (header row, column names, positions, metadata) live in a
small per-sheet table joined back on (workbook, sheet); AQE broadcasts it
when it is small and falls back to a shuffle join (with skew splitting)
when it is not.  Order-dependent steps use the bucketed primitives of
``sequence`` so that one huge sheet never sits in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.nulls import blank_to_null, is_in, trim_ws, true_or_false
from ledgerflow.operators.allocate import join_null_safe
from ledgerflow.operators.quality import fail_if_any
from ledgerflow.operators.sequence import DEFAULT_BUCKET, dense_sequence, fill_forward, one_bucket, row_bucket, small_groups

SHEET = ["workbook_id", "sheet_name"]

# Grid vocabulary of the source workbooks.
HEADER_MARKERS = ("Activity", "Activity Type", "Department")
KEY_STUDY = "Study"
KEY_STUDY_ID = "Study Id"
FLAG_SOME = "Scheduled / Some Participants"
FLAG_ALL = "Scheduled / All Participants"
FLAG_UA = "Unscheduled / Itemised Activities"
FLAG_MARKERS = (FLAG_SOME, FLAG_ALL, FLAG_UA)
FLAG_SETUP = "Setup & Closedown"
SUMMARY_MARKER = "Including MFF"
SHEET_UA = "Unscheduled Activities"
SHEET_SETUP = "Setup & Closedown"
SHEET_PHARMACY = "Pharmacy"
DEPT_PHARMACY = "Pharmacy"
ARM_SSP, ARM_UA, ARM_SC = "SSP", "UA", "SC"
COL_ACTIVITY = "Activity"
COL_TYPE = "Activity.Type"
COL_DEPARTMENT = "Department"
COL_ROLE = "Staff.Role"
COL_COST = "Activity.Cost"
COL_TOTAL = "Total.Activity.Cost"
# Reserved words that get a trailing dot when used as names.
RESERVED_NAMES = ("if", "else", "repeat", "while", "function", "for", "next", "break", "TRUE", "FALSE",
                  "NULL", "Inf", "NaN", "NA", "NA_integer_", "NA_real_", "NA_character_", "in")


def cell(i: Column | int) -> Column:
    """1-based cell access that yields NULL past the row's end."""
    return F.try_element_at(F.col("cells"), i if isinstance(i, Column) else F.lit(i))


# ---------------------------------------------------------------------------
# S3: key/value metadata

def sheet_metadata(grid: DataFrame) -> DataFrame:
    """First row whose trimmed first cell is ``Study`` / ``Study Id``; its
    trimmed second cell (blank -> NULL).  One row per sheet."""
    key = trim_ws(cell(1))
    val = blank_to_null(cell(2))
    return grid.groupBy(*SHEET).agg(
        F.min_by(val, F.when(key == KEY_STUDY, F.col("row_idx"))).alias("study_name"),
        F.min_by(val, F.when(key == KEY_STUDY_ID, F.col("row_idx"))).alias("cpms_id"))


# ---------------------------------------------------------------------------
# Header, cut, names, visit range

def is_header_row() -> Column:
    markers = F.array(*[F.lit(m) for m in HEADER_MARKERS])
    return F.size(F.array_except(markers, F.coalesce(F.col("cells"), F.array()))) == 0


def header_rows(grid: DataFrame) -> DataFrame:
    return grid.filter(is_header_row()).select(*SHEET, "row_idx")


def first_headers(grid: DataFrame) -> DataFrame:
    """(sheet, header_row, header_cells) for sheets that have a header."""
    hdr = F.when(is_header_row(), F.col("row_idx"))
    return (grid.groupBy(*SHEET)
            .agg(F.min(hdr).alias("header_row"), F.min_by("cells", hdr).alias("header_cells"))
            .filter(F.col("header_row").isNotNull()))


def syntactic_name(raw: Column) -> Column:
    """One header cell -> syntactically valid name (before de-duplication)."""
    text = F.coalesce(raw, F.lit("NA"))
    needs_x = ~text.rlike(r"^([A-Za-z]|[.]([^0-9]|$))")
    dotted = F.regexp_replace(F.when(needs_x, F.concat(F.lit("X"), text)).otherwise(text), r"[^A-Za-z0-9._]", ".")
    return F.when(dotted.isin(*RESERVED_NAMES), F.concat(dotted, F.lit("."))).otherwise(dotted)


def unique_names(bases: Column) -> Column:
    """make-unique over an array: a name's first place keeps it; each repeat
    gets the least ``.k`` that no other name has."""
    def one(done, i):
        name = F.element_at(bases, i)
        repeat = F.array_contains(F.slice(bases, 1, i - 1), name)
        suffixed = F.transform(F.sequence(F.lit(1), F.size(bases)), lambda k: F.concat(name, F.lit("."), k.cast("string")))
        free = F.filter(suffixed, lambda x: ~F.array_contains(bases, x) & ~F.array_contains(done, x))
        return F.array_append(done, F.when(repeat, F.element_at(free, 1)).otherwise(name))

    empty = F.array().cast("array<string>")
    places = F.when(F.size(bases) > 0, F.sequence(F.lit(1), F.size(bases))).otherwise(F.array().cast("array<int>"))
    all_differ = F.size(F.array_distinct(bases)) == F.size(bases)
    return F.when(all_differ, bases).otherwise(F.aggregate(places, empty, one))


def with_names(headers: DataFrame) -> DataFrame:
    """Adds ``names``: syntactic, unique column names of the header cells.
    The syntactic names are a column of their own so the de-duplication
    lambda reads them instead of re-running the regexes per element.  The
    names leave an ``explode`` of one element: filters on what is derived from
    them stay above it, where otherwise each would work out the names again."""
    based = headers.withColumn("_bases", F.transform("header_cells", syntactic_name))
    return based.select("*", F.explode(F.array(unique_names(F.col("_bases")))).alias("names")).drop("_bases")


def header_names(headers: DataFrame) -> DataFrame:
    """(sheet, col_pos, header, name): unique names, repeats suffixed .1, .2 ..."""
    named = with_names(headers)
    ex = named.select(*SHEET, F.posexplode(F.arrays_zip(F.col("header_cells").alias("header"),
                                                       F.col("names").alias("name"))).alias("p0", "hn"))
    return ex.select(*SHEET, (F.col("p0") + 1).cast("int").alias("col_pos"), F.col("hn.header").alias("header"),
                     F.col("hn.name").alias("name"))


def sheet_facts(grid: DataFrame) -> DataFrame:
    """One aggregation pass over the grid: header row and cells, metadata
    and sheet position per sheet (partial aggregates combine map-side)."""
    hdr = F.when(is_header_row(), F.col("row_idx"))
    key = trim_ws(cell(1))
    val = blank_to_null(cell(2))
    return grid.groupBy(*SHEET).agg(
        F.min(hdr).alias("header_row"), F.min_by("cells", hdr).alias("header_cells"),
        F.min_by(val, F.when(key == KEY_STUDY, F.col("row_idx"))).alias("study_name"),
        F.min_by(val, F.when(key == KEY_STUDY_ID, F.col("row_idx"))).alias("cpms_id"),
        F.first("sheet_pos").alias("sheet_pos"))


def sheet_layout(grid: DataFrame) -> DataFrame:
    """Per-sheet table: header row, names, column positions, visit range and metadata.
    Only rows that state a fact are aggregated: the table's body is not sorted for it."""
    states = is_header_row() | is_in(trim_ws(cell(1)), (KEY_STUDY, KEY_STUDY_ID))
    facts = with_names(sheet_facts(grid.filter(states)).filter(F.col("header_row").isNotNull()))
    pos = {c: F.array_position("names", c).cast("int") for c in
           (COL_ACTIVITY, COL_TYPE, COL_DEPARTMENT, COL_ROLE, COL_COST, COL_TOTAL)}
    return (facts.drop("header_cells")
            .withColumn("pos_activity", pos[COL_ACTIVITY]).withColumn("pos_type", pos[COL_TYPE])
            .withColumn("pos_department", pos[COL_DEPARTMENT]).withColumn("pos_role", pos[COL_ROLE])
            .withColumn("pos_cost", pos[COL_COST]).withColumn("pos_total", pos[COL_TOTAL])
            .withColumn("n_visits", F.col("pos_total") - F.col("pos_cost") - 1)
            .withColumn("layout_error",
                        F.when(F.col("pos_cost") == 0, F.lit("missing column " + COL_COST))
                        .when(F.col("pos_total") == 0, F.lit("missing column " + COL_TOTAL))
                        .when(F.col("n_visits") < 1, F.lit("no visit columns between the cost columns")))
            .withColumn("visit_names", F.when(F.col("layout_error").isNull(),
                                               F.slice("names", F.col("pos_cost") + 1, F.col("n_visits"))))
            .withColumn("first_name", F.element_at("names", 1)))


def rejected_sheets(grid: DataFrame, layout: DataFrame | None = None) -> DataFrame:
    """(workbook, sheet, reason) of every sheet that gives no table: no header
    row, or a header without usable cost columns."""
    layout = sheet_layout(grid) if layout is None else layout
    known = layout.select(*SHEET, "layout_error", F.lit(True).alias("_header"))
    sheets = join_null_safe(grid.select(*SHEET).distinct(), known, SHEET, "left")
    reason = F.when(F.col("_header").isNull(), F.lit("no header row")).otherwise(F.col("layout_error"))
    return sheets.select(*SHEET, reason.alias("reason")).filter(F.col("reason").isNotNull())


#: Sheets of a workbook that ``join_by_workbook`` takes together at most.
MANY_SHEETS = 1_000


def join_by_workbook(rows: DataFrame, per_sheet: DataFrame, how: str) -> DataFrame:
    """Join on ``SHEET`` (none of it NULL, a row per sheet at most) by the
    workbook alone: rows that are dealt by workbook stay where they are."""
    facts = [c for c in per_sheet.columns if c not in SHEET]
    per_sheet = per_sheet.filter(F.col("sheet_name").isNotNull())
    by_name = F.map_from_entries(F.collect_list(F.struct("sheet_name", F.struct(*facts))))
    met = rows.join(per_sheet.groupBy("workbook_id").agg(by_name.alias("_sheets")), "workbook_id", how)
    met = met.withColumn("_sheet", F.try_element_at("_sheets", F.col("sheet_name")))
    met = met.filter(F.col("_sheet").isNotNull()) if how == "inner" else met
    return met.select(*rows.columns, *[F.col(f"_sheet.{c}").alias(c) for c in facts])


def small_workbooks(grid: DataFrame, layout: DataFrame, bucket_size: int = DEFAULT_BUCKET) -> bool:
    """Whether every workbook can be one task's: neither more rows than a bucket nor very many sheets."""
    return small_groups(layout, "workbook_id", MANY_SHEETS) and small_groups(grid, "workbook_id", bucket_size)


def sheet_table(grid: DataFrame, layout: DataFrame, by_workbook: bool = False) -> DataFrame:
    """P2 cut + named fields: rows after the first header of sheets with a
    valid layout, with the fixed columns and the visit marks as an array.
    ``by_workbook``: rows are dealt by workbook (``small_workbooks``)."""
    lay = layout.filter(F.col("layout_error").isNull()).select(
        *SHEET, "sheet_pos", "header_row", "pos_activity", "pos_type", "pos_department", "pos_role", "pos_cost",
        "pos_total", "n_visits", "first_name", "study_name", "cpms_id")
    body = grid.drop("sheet_pos")
    if by_workbook:
        rows = join_by_workbook(body, lay, "inner")
    else:
        rows = join_null_safe(body, lay, SHEET, "inner", nulls=False)
    rows = rows.filter(F.col("row_idx") > F.col("header_row"))

    def at(p: str) -> Column:
        return F.when(F.col(p) > 0, cell(F.col(p)))

    marks = F.transform(F.sequence(F.lit(1), F.col("n_visits")), lambda i: cell(F.col("pos_cost") + i))
    return rows.select(*SHEET, "sheet_pos", "row_idx", cell(1).alias("first_cell"), "first_name",
                       at("pos_activity").alias("activity"), at("pos_type").alias("activity_type"),
                       at("pos_department").alias("department"), at("pos_role").alias("staff_role"),
                       at("pos_cost").alias("activity_cost"), marks.alias("marks"),
                       at("pos_total").alias("total_activity_cost"), "study_name", "cpms_id")


# ---------------------------------------------------------------------------
# Flags, cleaning, staff groups

def default_flag(sheet: Column) -> Column:
    return (F.when(sheet == SHEET_SETUP, F.lit(FLAG_SETUP))
            .when(sheet == SHEET_UA, F.lit(FLAG_UA))
            .otherwise(F.lit(FLAG_ALL)))


def with_flags(table: DataFrame, bucket_size: int = DEFAULT_BUCKET, single: bool = False) -> DataFrame:
    """Section marker of the first column carried forward (marker row
    included); rows before any marker take the sheet's default.
    ``single``: all row numbers are in one bucket (``one_bucket``)."""
    marked = table.withColumn("_marker", F.when(is_in("first_cell", FLAG_MARKERS), F.col("first_cell")))
    filled = fill_forward(marked, partition_cols=SHEET, order_col="row_idx", value_col="_marker",
                          out_col="_ff", bucket_size=bucket_size, nulls=False, single=single)
    return (filled.withColumn("flag", F.coalesce("_ff", default_flag(F.col("sheet_name"))))
            .drop("_marker", "_ff"))


def clean_rows(flagged: DataFrame) -> DataFrame:
    """Drop marker rows, rows without activity and repeated header rows."""
    marker_or_blank = is_in("activity", FLAG_MARKERS) | F.col("activity").isNull()
    repeated_header = true_or_false(F.col("first_cell") == F.col("first_name"))
    return (flagged.filter(~marker_or_blank & ~repeated_header)
            .withColumn("source_sheet", F.col("sheet_name")))


def with_staff_group(clean: DataFrame, bucket_size: int = DEFAULT_BUCKET, single: bool = False) -> DataFrame:
    """1, 2, ... for repeats of the same activity under the same flag, per sheet."""
    b = clean.withColumn("_b", row_bucket("row_idx", bucket_size))
    out = dense_sequence(b, partition_cols=SHEET + ["activity", "flag"], order_cols=["row_idx"],
                         bucket_col="_b", out_col="staff_group", single=single)
    return out.withColumn("staff_group", F.col("staff_group").cast("int")).drop("_b")


# ---------------------------------------------------------------------------
# marks

def coerce_mark(m: Column) -> Column:
    """Missing and ``N/A`` -> 0; other text -> number, garbage -> NULL."""
    return F.when(m.isNull() | (m == "N/A"), F.lit(0.0)).otherwise(m.try_cast("double"))


def numeric_marks(c: str = "marks") -> Column:
    return F.transform(F.col(c), coerce_mark)


def stored_layout(grid: DataFrame, stage: bool = True, strict: bool = True) -> DataFrame:
    """The layout, one row per sheet, written once with ``stage``.  ``strict``
    fails when a sheet has a header but no usable cost columns, as its rows
    would be left out; otherwise see ``rejected_sheets``."""
    from ledgerflow.sources.stage import materialize

    layout = sheet_layout(grid)
    layout = materialize(layout, "grid_layout") if stage else layout
    if strict:
        fail_if_any(layout.filter(F.col("layout_error").isNotNull()).select(*SHEET, "layout_error"), "sheets without usable cost columns")
    return layout


def stage_tables(grid: DataFrame, stage: bool = True, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(layout, raw table rows); with ``stage`` both are written once, as
    several steps read them."""
    from ledgerflow.sources.stage import materialize

    layout = stored_layout(grid, stage, strict)
    table = sheet_table(grid, layout)
    return layout, materialize(table, "grid_table") if stage else table


def flagged_rows(grid: DataFrame, bucket_size: int = DEFAULT_BUCKET, stage: bool = True, strict: bool = True) -> tuple[DataFrame, DataFrame, bool]:
    """(layout, table rows with flags, whether no sheet is larger than a bucket).

    Small workbooks are dealt whole, once, and nothing that follows deals them again
    (a grid in buckets of workbooks, ``materialize_dealt``, is not dealt at all).
    Else, if all row numbers are in one bucket, no sheet is larger than it: the
    rows stay as the join with the layout deals them, by sheet.  Else the table
    is stored before it is split."""
    from ledgerflow.sources.stage import materialize

    layout = stored_layout(grid, stage, strict)
    if small_workbooks(grid, layout, bucket_size):
        return layout, with_flags(sheet_table(grid, layout, by_workbook=True), bucket_size, single=True), True
    if one_bucket(grid, "row_idx", bucket_size):
        return layout, with_flags(sheet_table(grid, layout), bucket_size, single=True), True
    table = sheet_table(grid, layout)
    table = materialize(table, "grid_table") if stage else table
    return layout, with_flags(table, bucket_size), False


def cleaned(grid: DataFrame, bucket_size: int = DEFAULT_BUCKET, strict: bool = True, staff_groups: bool = True) -> DataFrame:
    """Cleaned rows alone, for a caller that reads them once."""
    _, flagged, single = flagged_rows(grid, bucket_size, strict=strict)
    clean = clean_rows(flagged)
    return with_staff_group(clean, bucket_size, single) if staff_groups else clean


def stage_a(grid: DataFrame, bucket_size: int = DEFAULT_BUCKET, stage: bool = True, strict: bool = True,
            staff_groups: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(layout, raw table rows, cleaned rows with flags and staff groups).

    Steps that do not look at staff groups leave them out: their numbering
    is another pass over the rows, and only its readers share the result."""
    from ledgerflow.sources.stage import materialize, materialize_dealt

    layout, flagged, single = flagged_rows(grid, bucket_size, stage, strict)
    if stage and single:
        flagged = materialize_dealt(flagged, "grid_table", "workbook_id")
    clean = clean_rows(flagged)
    if staff_groups:
        clean = with_staff_group(clean, bucket_size, single)
        clean = materialize(clean, "grid_clean") if stage and not single else clean
    return layout, flagged.drop("flag"), clean
