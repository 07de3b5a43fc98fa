"""Workbook-grid queries on ``fx_grid`` (every sheet of every study): stage A
(metadata, header, names, cleaning, flags, staff groups, cost table) and
stage B (rerouting, unpivot, arms, occurrence and row ids).

Oracles build the same stages as a DuckDB CTE chain with list functions and
correlated subqueries (Spark: bucketed windows and joins).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.operators import costs, grid, longform
from ledgerflow.operators.sequence import DEFAULT_BUCKET
from ledgerflow.plans.registry import register
from ledgerflow.sources.fixtures import Fixtures, duckdb_ctes


def grid_df(spark, sf_dir):
    return Fixtures(spark, sf_dir).grid.withColumnRenamed("cpms_id", "workbook_id")


def _stage_a(spark, sf_dir, **kw):
    return grid.stage_a(grid_df(spark, sf_dir), **kw)


def _stage_b(spark, sf_dir):
    layout, table, clean = _stage_a(spark, sf_dir)
    return longform.stage_b(clean, table, layout)


# ---------------------------------------------------------------------------
# Oracle chain (DuckDB)

_TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_MARKERS = "('Scheduled / Some Participants', 'Scheduled / All Participants', 'Unscheduled / Itemised Activities')"
_RESERVED = "(" + ", ".join(f"'{w}'" for w in grid.RESERVED_NAMES) + ")"

O_G = """g AS (SELECT cpms_id AS workbook_id, sheet_name, sheet_pos, row_idx, cells FROM fx_grid)"""
O_META = f"""meta AS (
  SELECT workbook_id, sheet_name,
    NULLIF(arg_min({_TRIM.format('cells[2]')}, row_idx) FILTER (WHERE {_TRIM.format('cells[1]')} = 'Study'), '') AS study_name,
    NULLIF(arg_min({_TRIM.format('cells[2]')}, row_idx) FILTER (WHERE {_TRIM.format('cells[1]')} = 'Study Id'), '') AS cpms_id
  FROM g GROUP BY workbook_id, sheet_name)"""
O_HDR = """hdr AS (
  SELECT workbook_id, sheet_name, MIN(row_idx) AS header_row FROM g
  WHERE list_contains(cells, 'Activity') AND list_contains(cells, 'Activity Type') AND list_contains(cells, 'Department')
  GROUP BY workbook_id, sheet_name)"""
O_HN = f"""hcell AS (
  SELECT g.workbook_id, g.sheet_name, CAST(generate_subscripts(g.cells, 1) AS INTEGER) AS col_pos, unnest(g.cells) AS header
  FROM g JOIN hdr ON g.workbook_id = hdr.workbook_id AND g.sheet_name = hdr.sheet_name AND g.row_idx = hdr.header_row),
hb AS (
  SELECT *, CASE WHEN d IN {_RESERVED} THEN d || '.' ELSE d END AS base FROM (
    SELECT *, regexp_replace(CASE WHEN regexp_matches(COALESCE(header, 'NA'), '^([A-Za-z]|[.]([^0-9]|$))')
                                  THEN COALESCE(header, 'NA') ELSE 'X' || COALESCE(header, 'NA') END,
                             '[^A-Za-z0-9._]', '.', 'g') AS d
    FROM hcell) x),
free AS (
  SELECT x.workbook_id, x.sheet_name, x.base, x.name, row_number() OVER (PARTITION BY x.workbook_id, x.sheet_name, x.base ORDER BY x.i) AS place
  FROM (SELECT DISTINCT workbook_id, sheet_name, base, i, base || '.' || CAST(i AS VARCHAR) AS name FROM hb, range(1, 40) r(i)) x
  WHERE NOT EXISTS (SELECT 1 FROM hb b WHERE b.workbook_id = x.workbook_id AND b.sheet_name = x.sheet_name AND b.base = x.name)),
hn AS (
  SELECT a.workbook_id, a.sheet_name, a.col_pos, a.header, COALESCE(f.name, a.base) AS name
  FROM (SELECT *, row_number() OVER (PARTITION BY workbook_id, sheet_name, base ORDER BY col_pos) - 1 AS k FROM hb) a
  LEFT JOIN free f ON f.workbook_id = a.workbook_id AND f.sheet_name = a.sheet_name AND f.base = a.base AND f.place = a.k)"""
O_LAY = """lay0 AS (
  SELECT h.workbook_id, h.sheet_name, h.header_row, list(n.name ORDER BY n.col_pos) AS names
  FROM hdr h JOIN hn n ON n.workbook_id = h.workbook_id AND n.sheet_name = h.sheet_name
  GROUP BY h.workbook_id, h.sheet_name, h.header_row),
lay AS (
  SELECT l.*, CAST(COALESCE(list_position(names, 'Activity'), 0) AS INTEGER) AS pos_activity,
         CAST(COALESCE(list_position(names, 'Activity.Type'), 0) AS INTEGER) AS pos_type,
         CAST(COALESCE(list_position(names, 'Department'), 0) AS INTEGER) AS pos_department,
         CAST(COALESCE(list_position(names, 'Staff.Role'), 0) AS INTEGER) AS pos_role,
         CAST(COALESCE(list_position(names, 'Activity.Cost'), 0) AS INTEGER) AS pos_cost,
         CAST(COALESCE(list_position(names, 'Total.Activity.Cost'), 0) AS INTEGER) AS pos_total,
         names[1] AS first_name, m.study_name, m.cpms_id
  FROM lay0 l LEFT JOIN meta m ON m.workbook_id = l.workbook_id AND m.sheet_name = l.sheet_name),
layv AS (
  SELECT *, pos_total - pos_cost - 1 AS n_visits, list_slice(names, pos_cost + 1, pos_total - 1) AS visit_names
  FROM lay WHERE pos_cost > 0 AND pos_total > 0 AND pos_total - pos_cost - 1 >= 1)"""
O_TBL = """tbl AS (
  SELECT g.workbook_id, g.sheet_name, g.sheet_pos, g.row_idx, g.cells[1] AS first_cell, l.first_name,
         CASE WHEN l.pos_activity > 0 THEN g.cells[l.pos_activity] END AS activity,
         CASE WHEN l.pos_type > 0 THEN g.cells[l.pos_type] END AS activity_type,
         CASE WHEN l.pos_department > 0 THEN g.cells[l.pos_department] END AS department,
         CASE WHEN l.pos_role > 0 THEN g.cells[l.pos_role] END AS staff_role,
         g.cells[l.pos_cost] AS activity_cost,
         list_transform(range(1, l.n_visits + 1), lambda i: g.cells[l.pos_cost + i]) AS marks,
         g.cells[l.pos_total] AS total_activity_cost, l.study_name, l.cpms_id
  FROM g JOIN layv l ON g.workbook_id = l.workbook_id AND g.sheet_name = l.sheet_name
  WHERE g.row_idx > l.header_row)"""
O_FLG = f"""flg AS (
  SELECT t.*, COALESCE(
    (SELECT arg_max(t2.first_cell, t2.row_idx) FROM tbl t2 WHERE t2.workbook_id = t.workbook_id
       AND t2.sheet_name = t.sheet_name AND t2.row_idx <= t.row_idx AND t2.first_cell IN {_MARKERS}),
    CASE t.sheet_name WHEN 'Setup & Closedown' THEN 'Setup & Closedown'
                      WHEN 'Unscheduled Activities' THEN 'Unscheduled / Itemised Activities'
                      ELSE 'Scheduled / All Participants' END) AS flag
  FROM tbl t)"""
O_CLN = f"""cln AS (
  SELECT *, sheet_name AS source_sheet FROM flg
  WHERE NOT (COALESCE(activity IN {_MARKERS}, FALSE) OR activity IS NULL)
    AND NOT COALESCE(first_cell = first_name, FALSE)),
sg AS (
  SELECT c.*, CAST((SELECT COUNT(*) FROM cln c2 WHERE c2.workbook_id = c.workbook_id AND c2.sheet_name = c.sheet_name
                    AND c2.activity = c.activity AND c2.flag = c.flag AND c2.row_idx <= c.row_idx) AS INTEGER) AS staff_group
  FROM cln c)"""

_MK = "list_transform({0}, lambda m: CASE WHEN m IS NULL OR m = 'N/A' THEN 0.0 ELSE TRY_CAST(m AS DOUBLE) END)"


def o_stage_a() -> str:
    return duckdb_ctes("fx_grid").rstrip() + ",\n" + ",\n".join([O_G, O_META, O_HDR, O_HN, O_LAY, O_TBL, O_FLG, O_CLN]) + "\n"


O_SUMMARY = """srow AS (
  SELECT workbook_id, sheet_name, arg_min(marks, row_idx) AS smarks FROM tbl
  WHERE COALESCE(strpos(activity_cost, 'Including MFF') > 0, FALSE) GROUP BY workbook_id, sheet_name),
summary AS (
  SELECT l.cpms_id, l.study_name AS study, printf('VISIT - %03d', i) AS visit_number,
         CASE WHEN s.sheet_name = 'Setup & Closedown' THEN 'SC' ELSE s.sheet_name END AS study_arm,
         l.visit_names[i] AS visit_label, CAST(NULL AS VARCHAR) AS activity_name,
         TRY_CAST(s.smarks[i] AS DOUBLE) AS ict_cost, CAST(NULL AS INTEGER) AS activity_occurrence_id,
         CAST(NULL AS INTEGER) AS staff_group, s.sheet_name AS source_sheet
  FROM srow s JOIN layv l ON l.workbook_id = s.workbook_id AND l.sheet_name = s.sheet_name,
       range(1, len(l.visit_names) + 1) r(i))"""

O_EXPAND = f"""pr AS (
  SELECT s.*, CASE flag WHEN 'Setup & Closedown' THEN 'SC' WHEN 'Scheduled / Some Participants' THEN 'SSP' ELSE 'UA' END AS parm,
         {_MK.format('s.marks')} AS mk,
         (SELECT l.visit_names FROM layv l JOIN srow r ON r.workbook_id = l.workbook_id AND r.sheet_name = l.sheet_name
           WHERE l.workbook_id = s.workbook_id AND l.sheet_name = s.sheet_name) AS label_names
  FROM sg s WHERE flag IN ('Setup & Closedown', 'Scheduled / Some Participants', 'Unscheduled / Itemised Activities')),
pr2 AS (
  SELECT *, list_transform(mk, lambda x: COALESCE(x, 0.0)) AS filled,
         CASE WHEN list_count(mk) < len(mk) THEN NULL ELSE list_sum(mk) END AS raw_total FROM pr),
pr3 AS (
  SELECT *, CASE WHEN raw_total IS NULL OR raw_total = 0 THEN 1.0 ELSE round_even(raw_total, 0) END AS total_occ,
         list_sum(filled) = 0 AS none_marked FROM pr2),
pv AS (
  SELECT p.*, i AS vpos, CASE WHEN none_marked AND i = 1 THEN 1.0 ELSE filled[i] END AS n
  FROM pr3 p, range(1, len(p.filled) + 1) r(i)),
pc AS (
  SELECT v.*, c AS copy FROM pv v, range(1, CAST(floor(v.n) AS BIGINT) + 1) r(c) WHERE floor(v.n) >= 1),
expanded AS (
  SELECT cpms_id, study_name AS study, printf('VISIT - %03d', vpos) AS visit_number, parm AS study_arm,
         COALESCE(label_names[vpos], printf('VISIT - %03d', vpos)) AS visit_label, activity AS activity_name,
         CASE WHEN total_occ = 0 THEN NULL ELSE TRY_CAST(total_activity_cost AS DOUBLE) / total_occ END AS ict_cost,
         CAST(row_number() OVER (PARTITION BY workbook_id, sheet_name, parm, vpos, activity ORDER BY row_idx, vpos, copy)
              AS INTEGER) AS activity_occurrence_id,
         staff_group, sheet_name AS source_sheet
  FROM pc)"""

O_STAGE_B = f"""hasua AS (
  SELECT workbook_id, bool_or(sheet_name = 'Unscheduled Activities') AS has_ua_sheet FROM tbl GROUP BY workbook_id),
routed AS (
  SELECT s.*, s.sheet_pos AS source_sheet_pos,
    CASE WHEN {_TRIM.format('s.sheet_name')} IN ('Setup & Closedown', 'Pharmacy', 'Unscheduled Activities') THEN {_TRIM.format('s.sheet_name')}
         WHEN s.flag = 'Unscheduled / Itemised Activities' AND NOT COALESCE(h.has_ua_sheet, FALSE) THEN 'Unscheduled Activities'
         WHEN s.department = 'Pharmacy' THEN 'Pharmacy'
         ELSE {_TRIM.format('s.sheet_name')} END AS target_sheet
  FROM sg s LEFT JOIN hasua h ON h.workbook_id = s.workbook_id),
routed2 AS (SELECT *, CAST(target_sheet <> {_TRIM.format('sheet_name')} AS INTEGER) AS is_moved FROM routed),
lv AS (
  SELECT r.*, i AS visit_pos,
         CASE WHEN target_sheet IN ('Unscheduled Activities', 'Setup & Closedown') THEN CASE WHEN i = 1 THEN 1 END
              ELSE TRY_CAST({_MK.format('r.marks')}[i] AS INTEGER) END AS n
  FROM routed2 r, range(1, len(r.marks) + 1) t(i)),
lc AS (
  SELECT l.*, CAST(c AS INTEGER) AS copy, printf('VISIT - %03d', visit_pos) AS visit,
         CASE flag WHEN 'Scheduled / Some Participants' THEN 'SSP' WHEN 'Unscheduled / Itemised Activities' THEN 'UA'
                   WHEN 'Setup & Closedown' THEN 'SC' ELSE source_sheet END AS study_arm
  FROM lv l, range(1, l.n + 1) r(c) WHERE l.n >= 1),
flat AS (
  SELECT workbook_id, target_sheet, bool_or(study_arm IN ('UA', 'SC', 'SSP')) AS any_pseudo FROM lc GROUP BY ALL),
occ AS (
  SELECT l.*, CAST(CASE WHEN f.any_pseudo OR l.target_sheet IN ('Unscheduled Activities', 'Setup & Closedown') THEN 1
         ELSE row_number() OVER (PARTITION BY l.workbook_id, l.target_sheet, l.study_arm, l.activity, l.visit
                                 ORDER BY l.is_moved, l.source_sheet_pos, l.row_idx, l.visit_pos, l.copy) END AS INTEGER)
         AS activity_occurrence_id
  FROM lc l JOIN flat f ON f.workbook_id = l.workbook_id AND f.target_sheet = l.target_sheet),
spos AS (
  SELECT workbook_id, {_TRIM.format('sheet_name')} AS sname, MIN(sheet_pos) AS pos FROM g GROUP BY ALL),
slast AS (SELECT workbook_id, MAX(sheet_pos) AS lastpos FROM g GROUP BY workbook_id),
rid AS (
  SELECT o.*, COALESCE(p.pos, CASE o.target_sheet WHEN 'Unscheduled Activities' THEN s.lastpos + 1
                                                  WHEN 'Pharmacy' THEN s.lastpos + 2 END) AS target_sheet_pos
  FROM occ o LEFT JOIN spos p ON p.workbook_id = o.workbook_id AND p.sname = o.target_sheet
             LEFT JOIN slast s ON s.workbook_id = o.workbook_id),
longr AS (
  SELECT *, row_number() OVER (PARTITION BY workbook_id ORDER BY target_sheet_pos, is_moved, source_sheet_pos,
                                                                 row_idx, visit_pos, copy) AS row_id
  FROM rid)"""


# ---------------------------------------------------------------------------
# S3 / P1 / P2 / P3 / P4

@register("kv_metadata", duckdb_ctes("fx_grid").rstrip() + ",\n" + O_G + ",\n" + O_META + "\nSELECT * FROM meta")
def q_kv_metadata(spark, sf_dir):
    return grid.sheet_metadata(grid_df(spark, sf_dir))


def spoiled(g):
    """The grid with 'Activity Cost' misspelt in sheets 'Arm B' and without the header row in 'Pharmacy' sheets."""
    fixed = F.transform("cells", lambda c: F.when((c == "Activity Cost") & (F.col("sheet_name") == "Arm B"), F.lit("Activity cost")).otherwise(c))
    return g.withColumn("cells", fixed).filter(~((F.col("sheet_name") == "Pharmacy") & (F.col("row_idx") == 4)))


@register("rejected_sheets", duckdb_ctes("fx_grid").rstrip() + """,
b AS (SELECT cpms_id AS workbook_id, sheet_name, row_idx,
             CASE WHEN sheet_name = 'Arm B' THEN list_transform(cells, lambda c: CASE WHEN c = 'Activity Cost' THEN 'Activity cost' ELSE c END) ELSE cells END AS cells
      FROM fx_grid WHERE NOT (sheet_name = 'Pharmacy' AND row_idx = 4)),
h AS (SELECT workbook_id, sheet_name, arg_min(cells, row_idx) FILTER (WHERE list_contains(cells, 'Activity') AND list_contains(cells, 'Activity Type')
             AND list_contains(cells, 'Department')) AS hc FROM b GROUP BY workbook_id, sheet_name)
SELECT workbook_id, sheet_name, CASE WHEN hc IS NULL THEN 'no header row' ELSE 'missing column Activity.Cost' END AS reason
FROM h WHERE hc IS NULL OR NOT list_contains(hc, 'Activity Cost')""")
def q_rejected_sheets(spark, sf_dir):
    """Sheets whose rows no stage can use, with the reason."""
    return grid.rejected_sheets(spoiled(grid_df(spark, sf_dir)))


@register("header_rows", duckdb_ctes("fx_grid").rstrip() + ",\n" + O_G + """
SELECT workbook_id, sheet_name, row_idx FROM g
WHERE list_contains(cells, 'Activity') AND list_contains(cells, 'Activity Type') AND list_contains(cells, 'Department')""")
def q_header_rows(spark, sf_dir):
    return grid.header_rows(grid_df(spark, sf_dir))


@register("section_cut", o_stage_a() + "SELECT workbook_id, sheet_name, row_idx, first_cell FROM tbl")
def q_section_cut(spark, sf_dir):
    """Rows after the first header row of each sheet (the table body)."""
    _, table = grid.stage_tables(grid_df(spark, sf_dir), stage=False, strict=False)
    return table.select("workbook_id", "sheet_name", "row_idx", "first_cell")


@register("header_names", o_stage_a() + "SELECT * FROM hn")
def q_header_names(spark, sf_dir):
    g = grid_df(spark, sf_dir)
    return grid.header_names(grid.first_headers(g))


@register("visit_range", o_stage_a() + """
SELECT workbook_id, sheet_name, pos_cost, pos_total, n_visits, visit_names[1] AS first_visit,
       visit_names[n_visits] AS last_visit FROM layv""")
def q_visit_range(spark, sf_dir):
    layout = grid.sheet_layout(grid_df(spark, sf_dir))
    return (layout.filter(F.col("layout_error").isNull())
            .select("workbook_id", "sheet_name", "pos_cost", "pos_total", "n_visits",
                    F.element_at("visit_names", 1).alias("first_visit"),
                    F.element_at("visit_names", F.col("n_visits")).alias("last_visit")))


# ---------------------------------------------------------------------------
# W1 / P5-P7 / W2 / P8

@register("flag_fill_forward", o_stage_a() + "SELECT workbook_id, sheet_name, row_idx, first_cell, flag FROM flg")
def q_flag_fill_forward(spark, sf_dir):
    _, flagged, _ = grid.flagged_rows(grid_df(spark, sf_dir), strict=False)
    return flagged.select("workbook_id", "sheet_name", "row_idx", "first_cell", "flag")


_CLEAN_COLS = ("workbook_id", "sheet_name", "row_idx", "activity", "activity_type", "department", "staff_role",
               "activity_cost", "total_activity_cost", "flag", "study_name", "cpms_id", "source_sheet")


@register("clean_rows", o_stage_a() + "SELECT " + ", ".join(_CLEAN_COLS) + " FROM cln")
def q_clean_rows(spark, sf_dir):
    return grid.cleaned(grid_df(spark, sf_dir), strict=False, staff_groups=False).select(*_CLEAN_COLS)


@register("staff_group", o_stage_a() + "SELECT workbook_id, sheet_name, row_idx, activity, flag, staff_group FROM sg")
def q_staff_group(spark, sf_dir):
    clean = grid.cleaned(grid_df(spark, sf_dir))
    return clean.select("workbook_id", "sheet_name", "row_idx", "activity", "flag", "staff_group")


@register("mark_coerce", o_stage_a() + f"""
SELECT workbook_id, sheet_name, row_idx, printf('VISIT - %03d', i) AS visit, {_MK.format('marks')}[i] AS mark
FROM sg, range(1, len(marks) + 1) r(i)""")
def q_mark_coerce(spark, sf_dir):
    """P8 + P9: marks of cleaned rows as numbers, visits renumbered."""
    from ledgerflow.functions.text import visit_number
    clean = grid.cleaned(grid_df(spark, sf_dir), staff_groups=False)
    ex = clean.select("workbook_id", "sheet_name", "row_idx", F.posexplode(grid.numeric_marks()).alias("p0", "mark"))
    return ex.select("workbook_id", "sheet_name", "row_idx", visit_number(F.col("p0") + 1).alias("visit"), "mark")


# ---------------------------------------------------------------------------
# R2 / R3 / R4 / J12 / A1 / A2 / W3

@register("summary_transpose", o_stage_a().rstrip() + ",\n" + O_SUMMARY + "\nSELECT * FROM summary")
def q_summary_transpose(spark, sf_dir):
    layout, table = grid.stage_tables(grid_df(spark, sf_dir))
    return costs.summary_costs(table, layout)


_EXPANDED_SQL = o_stage_a().rstrip() + ",\n" + O_SUMMARY + ",\n" + O_EXPAND + "\nSELECT * FROM expanded"


@register("expand_cost_rows", _EXPANDED_SQL)
def q_expand_cost_rows(spark, sf_dir):
    layout, table, clean = _stage_a(spark, sf_dir)
    return costs.expand_cost_rows(clean, costs.label_lookup(table, layout))


@register("expand_cost_rows_split", _EXPANDED_SQL)
def q_expand_cost_rows_split(spark, sf_dir):
    """W3 with sheets above the bound."""
    layout, table, clean = _stage_a(spark, sf_dir)
    return costs.expand_cost_rows(clean, costs.label_lookup(table, layout), bucket_size=SMALL_BUCKET)


# ---------------------------------------------------------------------------
# P13 / P10 / R1 / P14 / W4 / W5

_B = o_stage_a().rstrip() + ",\n" + O_STAGE_B + "\n"


@register("reroute_sheets", _B + """
SELECT workbook_id, source_sheet, row_idx, flag, department, target_sheet AS sheet_name, is_moved FROM routed2""")
def q_reroute_sheets(spark, sf_dir):
    layout, table, clean = _stage_a(spark, sf_dir, staff_groups=False)
    routed = longform.reroute(clean, longform.workbook_has_ua(table))
    return routed.select("workbook_id", "source_sheet", "row_idx", "flag", "department",
                         F.col("target_sheet").alias("sheet_name"), "is_moved")


_LONG_COLS = ("workbook_id", "sheet_name", "source_sheet", "row_idx", "visit", "copy", "activity", "flag",
              "study_arm")
_LONG_SQL = ("workbook_id, target_sheet AS sheet_name, source_sheet, row_idx, visit, copy, activity, flag, "
             "study_arm")


@register("unpivot_marks", _B + f"SELECT {_LONG_SQL} FROM lc")
def q_unpivot_marks(spark, sf_dir):
    """One long row per occurrence of an activity at a visit."""
    _, table, clean = _stage_a(spark, sf_dir, staff_groups=False)
    long = longform.long_rows(longform.reroute(clean, longform.workbook_has_ua(table)))
    return long.select(*_LONG_COLS)


@register("first_visit_reduce", _B + f"""
SELECT {_LONG_SQL} FROM lc WHERE target_sheet IN ('Unscheduled Activities', 'Setup & Closedown')""")
def q_first_visit_reduce(spark, sf_dir):
    """P10: UA and Setup sheets keep one row per activity, at the first visit."""
    _, table, clean = _stage_a(spark, sf_dir, staff_groups=False)
    long = longform.long_rows(longform.reroute(clean, longform.workbook_has_ua(table)))
    return long.filter(F.col("sheet_name").isin(*longform.FIRST_VISIT_SHEETS)).select(*_LONG_COLS)


@register("study_arm", o_stage_a() + """
SELECT workbook_id, sheet_name, row_idx, flag,
       CASE flag WHEN 'Scheduled / Some Participants' THEN 'SSP' WHEN 'Unscheduled / Itemised Activities' THEN 'UA'
                 WHEN 'Setup & Closedown' THEN 'SC' ELSE source_sheet END AS study_arm FROM sg""")
def q_study_arm(spark, sf_dir):
    clean = grid.cleaned(grid_df(spark, sf_dir), staff_groups=False)
    return clean.select("workbook_id", "sheet_name", "row_idx", "flag", longform.study_arm().alias("study_arm"))


#: Row numbers a bucket: most sheets of the given tables are above it.
SMALL_BUCKET = 3


def _occurrence_ids(spark, sf_dir, bucket_size=DEFAULT_BUCKET):
    _, table, clean = _stage_a(spark, sf_dir, staff_groups=False)
    routed = longform.reroute(clean.withColumnRenamed("sheet_pos", "source_sheet_pos"), longform.workbook_has_ua(table))
    visits = longform.visit_rows(longform.by_target_sheet(longform.with_visit_counts(routed)))
    read = ["is_moved", "source_sheet_pos", "visit_pos", "n", "n_before"]
    visits = visits.select(*[c for c in _LONG_COLS if c != "copy"], *read)
    return longform.numbered_occurrences(visits, bucket_size, *longform.numbered_whole(clean, bucket_size)).select(*_LONG_COLS, "activity_occurrence_id")


_OCC_SQL = _B + f"SELECT {_LONG_SQL}, activity_occurrence_id FROM occ"


@register("occurrence_ids", _OCC_SQL)
def q_occurrence_ids(spark, sf_dir):
    return _occurrence_ids(spark, sf_dir)


@register("occurrence_ids_split", _OCC_SQL)
def q_occurrence_ids_split(spark, sf_dir):
    """W4 with sheets above the bound: counted over many buckets, moved rows among them."""
    return _occurrence_ids(spark, sf_dir, bucket_size=SMALL_BUCKET)


_ROW_SQL = _B + f"SELECT {_LONG_SQL}, activity_occurrence_id, target_sheet_pos, row_id FROM longr"


@register("row_ids", _ROW_SQL)
def q_row_ids(spark, sf_dir):
    """C3 output: long rows with arm, occurrence id and per-workbook row id."""
    long = _stage_b(spark, sf_dir)
    return long.select(*_LONG_COLS, "activity_occurrence_id", "target_sheet_pos", "row_id")


@register("row_ids_split", _ROW_SQL)
def q_row_ids_split(spark, sf_dir):
    """W5 with sheets above the bound."""
    layout, table, clean = _stage_a(spark, sf_dir)
    long = longform.stage_b(clean, table, layout, bucket_size=SMALL_BUCKET)
    return long.select(*_LONG_COLS, "activity_occurrence_id", "target_sheet_pos", "row_id")
