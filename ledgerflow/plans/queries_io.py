"""Cost-table, stacking, upsert, audit and export-shaping queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.operators import costs, longform
from ledgerflow.operators.rules import with_defaults
from ledgerflow.plans.queries_grid import O_EXPAND, O_SUMMARY, _B, _stage_a, _stage_b, grid_df, o_stage_a
from ledgerflow.plans.queries_templates import _ALL, ADJ_SQL, adjusted
from ledgerflow.plans.registry import register
from ledgerflow.operators.costjoin import join_ict_costs
from ledgerflow.plans.queries_posting import LINE_COLS, O_CTX, RULESET, o_lines, o_plan, rule_tables, stored_plan
from ledgerflow.sinks import files
from ledgerflow.sinks.files import report_format, safe_sheet_names
from ledgerflow.sources import readers
from ledgerflow.sources.fixtures import Fixtures, VIEWS, dialect, duckdb_ctes
from ledgerflow.sources.readers import COST_SCAN_COLUMNS
from ledgerflow.sources.stage import is_dealt, materialize

_COSTS_SQL = o_stage_a().rstrip() + ",\n" + O_SUMMARY + ",\n" + O_EXPAND + """,
batch AS (SELECT * FROM summary UNION ALL SELECT * FROM expanded)
"""


def grid_costs(spark, sf_dir):
    layout, table, clean = _stage_a(spark, sf_dir)
    return costs.cost_table(table, layout, clean)


@register("cost_table_grid", _COSTS_SQL + "SELECT * FROM batch")
def q_cost_table_grid(spark, sf_dir):
    """C1 output: the cost table of all workbooks (summary + pseudo-arm rows)."""
    return grid_costs(spark, sf_dir)


@register("not_null_audit", _COSTS_SQL + """
SELECT cpms_id, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE cpms_id IS NULL OR visit_number IS NULL OR study_arm IS NULL OR ict_cost IS NULL)
         AS n_violations
FROM batch GROUP BY cpms_id""")
def q_not_null_audit(spark, sf_dir):
    """K3 / Q6: per study, cost rows that would break the NOT NULL columns."""
    c = grid_costs(spark, sf_dir)
    bad = F.col("cpms_id").isNull()
    for k in ("visit_number", "study_arm", "ict_cost"):
        bad = bad | F.col(k).isNull()
    return c.groupBy("cpms_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.count(F.when(bad, 1)).alias("n_violations"))


_FX_COST = dialect(VIEWS["fx_cost"][0], "duckdb")
_FX_LONG = dialect(VIEWS["fx_long"][0], "duckdb")


@register("upsert_costs", _COSTS_SQL.rstrip() + f""",
fx_long AS ({_FX_LONG}),
fx_cost AS ({_FX_COST})
SELECT * FROM fx_cost t
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.cpms_id IS NOT DISTINCT FROM t.cpms_id
                  AND b.visit_number IS NOT DISTINCT FROM t.visit_number AND b.study_arm IS NOT DISTINCT FROM t.study_arm)
UNION ALL SELECT * FROM batch""")
def q_upsert_costs(spark, sf_dir):
    """K2: the stored cost table with every (study, visit, arm) of the grid batch replaced."""
    fx = Fixtures(spark, sf_dir)
    fx.base  # stored first: the grid and the stored costs are both built on it
    target = fx.cost
    return costs.upsert(target, grid_costs(spark, sf_dir))


_STACK_COLS = ("origin", "cpms_id", "sheet_name", "visit", "visit_label", "staff_group", "calc_tag", "provider_org",
               "flag")


@register("stack_by_name", _B.rstrip() + f""",
fx_long AS ({_FX_LONG}),
gl AS (SELECT 'grid' AS origin, cpms_id, target_sheet AS sheet_name, visit, visit AS visit_label, staff_group,
              CAST(NULL AS VARCHAR) AS calc_tag, CAST(NULL AS VARCHAR) AS provider_org, flag FROM longr),
fl AS (SELECT 'fixture' AS origin, cpms_id, sheet_name, visit, visit_label, staff_group, calc_tag, provider_org FROM fx_long)
SELECT * FROM gl UNION ALL BY NAME SELECT * FROM fl""")
def q_stack_by_name(spark, sf_dir):
    """S4 + U1 + P17: long rows of the grids and stored long rows stacked by
    column name; missing optional columns take their defaults or NULL."""
    fx = Fixtures(spark, sf_dir)
    fx.base  # stored first: the grid and the stored lines are both built on it
    stored = fx.long
    long = _stage_b(spark, sf_dir)
    g = (with_defaults(long.select("cpms_id", "sheet_name", "visit", "staff_group", "flag"))
         .withColumn("origin", F.lit("grid")))
    fx = stored.select("cpms_id", "sheet_name", "visit", "visit_label", "staff_group",
                       "calc_tag", "provider_org").withColumn("origin", F.lit("fixture"))
    out = longform.stack_frames([g, fx])
    return out.select(*_STACK_COLS)


@register("safe_sheet_names", _ALL + """,
names AS (SELECT DISTINCT cpms_id, scenario_id, template_kind, template_name FROM allt),
safe AS (SELECT *, substr(regexp_replace(template_name, '[\\[\\]\\*\\?:/\\\\]', '_', 'g'), 1, 31) AS s FROM names),
num AS (SELECT a.*, (SELECT COUNT(*) FROM safe b WHERE b.cpms_id = a.cpms_id AND b.scenario_id = a.scenario_id
                     AND b.s = a.s AND (b.template_kind, b.template_name) <= (a.template_kind, a.template_name)) AS n
        FROM safe a)
SELECT cpms_id, scenario_id, template_kind, template_name,
       CASE WHEN n = 1 THEN s ELSE substr(s, 1, 31 - 1 - length(CAST(n AS VARCHAR))) || '_' || CAST(n AS VARCHAR) END
         AS safe_name
FROM num""")
def q_safe_sheet_names(spark, sf_dir):
    """K8: collision-free export sheet names per study and scenario."""
    from ledgerflow.plans.queries_templates import templates_of
    t = templates_of(adjusted(spark, sf_dir, stage=True))
    names = t.select("cpms_id", "scenario_id", "template_kind", "template_name").distinct()
    return safe_sheet_names(names, name_col="template_name", scope_cols=["cpms_id", "scenario_id"],
                            order_cols=["template_kind", "template_name"])


_FMT_COLS = ("cpms_id", "row_id", "scenario_id", "posting_line_type_id", "posting_amount", "contract_cost",
             "contract_price", "base_sum", "adjusted_amount", "multiplier", "residual")


def _o_money(c):
    v = f"round_even(CAST({c} AS DECIMAL(38,6)), 2)"
    return (f"CASE WHEN {v} < 0 THEN '-£' || format('{{:,.2f}}', abs({v})) "
            f"ELSE '£' || format('{{:,.2f}}', {v}) END AS {c}")


def _o_num(c):
    return f"format('{{:,.4f}}', round_even(CAST({c} AS DECIMAL(38,6)), 4)) AS {c}"


_REPORT_SQL = "SELECT " + ", ".join(
    ["cpms_id", _o_num("row_id"), "scenario_id", "posting_line_type_id"]
    + [_o_money(c) for c in ("posting_amount", "contract_cost", "contract_price", "base_sum", "adjusted_amount")]
    + [_o_num("multiplier"), _o_num("residual")]) + " FROM (" + ADJ_SQL + ") q"


@register("report_format", _REPORT_SQL)
def q_report_format(spark, sf_dir):
    """Money columns as pounds with 2 decimals, other numbers with 4."""
    return report_format(adjusted(spark, sf_dir, columns=_FMT_COLS))


# ---------------------------------------------------------------------------
# Written by a sink and read back

def _fresh(df, name):
    from ledgerflow.sources.stage import stage_path
    return stage_path(df, name)


_COST_COLS = ", ".join(COST_SCAN_COLUMNS)


@register("sink_cost_table", duckdb_ctes("fx_cost").rstrip() + f" SELECT {_COST_COLS} FROM fx_cost")
def q_sink_cost_table(spark, sf_dir):
    """K1 + S6: the cost table written twice, the second time study by study, and scanned."""
    costs_df = Fixtures(spark, sf_dir).cost
    path = _fresh(costs_df, "sink_cost")
    files.write_cost_table(costs_df, path, strict=False)
    files.write_cost_table(costs_df, path, mode="studies", strict=False)
    return readers.read_cost_table(spark, path).select(*COST_SCAN_COLUMNS)


@register("sink_upsert", _COSTS_SQL.rstrip() + f""",
fx_long AS ({_FX_LONG}),
fx_cost AS ({_FX_COST}),
b AS (SELECT * FROM batch WHERE cpms_id IS NOT NULL AND visit_number IS NOT NULL AND study_arm IS NOT NULL AND ict_cost IS NOT NULL),
t AS (SELECT * FROM fx_cost WHERE cpms_id IS NOT NULL AND visit_number IS NOT NULL AND study_arm IS NOT NULL AND ict_cost IS NOT NULL)
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.cpms_id = t.cpms_id AND b.visit_number = t.visit_number AND b.study_arm = t.study_arm)
UNION ALL SELECT * FROM b""")
def q_sink_upsert(spark, sf_dir):
    """K2 + K3: the stored cost table, then the grid batch upserted: a new version of the studies that it touches."""
    whole = lambda df: df.dropna(subset=["cpms_id", "visit_number", "study_arm", "ict_cost"])
    target = whole(Fixtures(spark, sf_dir).cost).withColumn("ict_cost", F.col("ict_cost").cast("double"))  # as the batch has it
    path = _fresh(target, "sink_upsert")
    files.write_cost_table(target, path)
    return files.upsert_cost_table(path, whole(grid_costs(spark, sf_dir))).select(target.columns)


def _places(files_read, *folder):
    """Each row's place in its folder, when the files are read one after another by name."""
    read = files_read.withColumns({"_file": F.col("_metadata.file_name"), "_at": F.col("_metadata.file_block_start"), "_line": F.monotonically_increasing_id()})
    return read.withColumn("place", F.row_number().over(Window.partitionBy(*folder).orderBy("_file", "_at", "_line"))).drop("_file", "_at", "_line")


_PLAN_COLS = ("cpms_id", "row_id", "scenario_id", "sheet_name", "study_arm", "activity", "visit", "staff_group",
              "posting_line_type_id", "posting_amount", "contract_cost", "destination_entity")
_PLAN_ORDER = "row_id NULLS LAST, posting_line_type_id NULLS LAST"


def _plan_a(spark, sf_dir):
    return stored_plan(Fixtures(spark, sf_dir), "posting_plan")


@register("sink_posting_csv", o_plan("A").rstrip() + f"""
SELECT {", ".join(_PLAN_COLS)}, row_number() OVER (PARTITION BY cpms_id ORDER BY {_PLAN_ORDER}) AS place FROM plan""")
def q_sink_posting_csv(spark, sf_dir):
    """K4 + F1: the posting plan through its CSV export: whole rows, and their order over the files."""
    plan = _plan_a(spark, sf_dir)
    path = _fresh(plan, "sink_csv")
    files.write_posting_csv(plan, path, stored=is_dealt(plan, "cpms_id"))
    return _places(spark.read.option("header", True).schema(plan.schema).csv(path), "cpms_id").select(*_PLAN_COLS, "place")


_SAFE_SQL = "substr(regexp_replace(sheet_name, '[\\[\\]\\*\\?:/\\\\]', '_', 'g'), 1, 31)"


@register("sink_per_sheet", o_plan("A").rstrip() + f"""
SELECT {", ".join(_PLAN_COLS)}, {_SAFE_SQL} AS safe_sheet,
       row_number() OVER (PARTITION BY cpms_id, sheet_name ORDER BY {_PLAN_ORDER}) AS place FROM plan""")
def q_sink_per_sheet(spark, sf_dir):
    """K5 + F1: one folder per study and sheet: whole rows, and their order in the folder."""
    plan = _plan_a(spark, sf_dir)
    path = _fresh(plan, "sink_sheets")
    files.write_per_sheet(plan, path)
    return _places(_typed(spark.read, plan, "safe_sheet string").parquet(path), "cpms_id", "safe_sheet").select(*_PLAN_COLS, "safe_sheet", "place")


def _typed(reader, df, *more):
    """A reader with the schema that ``df`` was written with (folder names stay text)."""
    return reader.schema(", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields], *more]))


@register("sink_posting_sheets", o_plan("A").rstrip() + f"""
SELECT {", ".join(_PLAN_COLS)}, {_SAFE_SQL} AS safe_sheet, '2024-02-29' AS export_date,
       row_number() OVER (PARTITION BY cpms_id, sheet_name ORDER BY {_PLAN_ORDER}) AS place FROM plan""")
def q_sink_posting_sheets(spark, sf_dir):
    """K6 + F1: the posting export, in folders by date, study, scenario and sheet."""
    plan = _plan_a(spark, sf_dir)
    path = _fresh(plan, "sink_posting_sheets")
    files.write_posting_per_sheet(plan, path, date="2024-02-29")
    # CSV files have their columns by place: those of the folders come last.
    inside = plan.drop("cpms_id", "scenario_id")
    reader = _typed(spark.read.option("header", True), inside, "export_date string", "cpms_id string", "scenario_id string", "safe_sheet string")
    return _places(reader.csv(path), "cpms_id", "safe_sheet").select(*_PLAN_COLS, "safe_sheet", "export_date", "place")


@register("sink_templates", _ALL + "SELECT * FROM allt")
def q_sink_templates(spark, sf_dir):
    """K7: every import template through its export, one folder each."""
    from ledgerflow.plans.queries_templates import templates_of
    t = materialize(templates_of(adjusted(spark, sf_dir, stage=True)), "templates")
    path = _fresh(t, "sink_templates")
    files.write_templates(t, path, fmt="parquet")
    return _typed(spark.read, t, "template_sheet string").parquet(path).select(t.columns)


@register("reader_scenarios", duckdb_ctes("fx_dist_rules").rstrip() + "\nSELECT DISTINCT scenario_id FROM fx_dist_rules")
def q_reader_scenarios(spark, sf_dir):
    """S8 + F3: the scenarios that the stored rule table offers."""
    fx = Fixtures(spark, sf_dir)
    path = _fresh(fx.dist_rules, "scenarios")
    fx.dist_rules.write.parquet(path)
    return readers.scenario_list(spark.read.parquet(path))


@register("reader_grids", duckdb_ctes("fx_grid").rstrip() + """,
t AS (SELECT cpms_id AS workbook_id, CASE WHEN sheet_name = 'Arm B' AND row_idx % 3 = 0 THEN 'unreadable record'
             WHEN sheet_name = 'Pharmacy' AND row_idx = 4 THEN 'no row number' END AS reason FROM fx_grid)
SELECT CASE WHEN reason = 'unreadable record' THEN NULL ELSE workbook_id END AS workbook_id, reason, COUNT(*) AS n_rows FROM t GROUP BY ALL""")
def q_reader_grids(spark, sf_dir):
    """S1 + S2: stored grids read with their rejects: records cut in half, and rows without a number."""
    g = grid_df(spark, sf_dir).select(*[f.name for f in readers.GRID_SCHEMA.fields])
    numbered = F.when((F.col("sheet_name") == "Pharmacy") & (F.col("row_idx") == 4), F.lit(None)).otherwise(F.col("row_idx"))
    text = F.to_json(F.struct(*[numbered.alias("row_idx") if c == "row_idx" else F.col(c) for c in g.columns]))
    cut = F.when((F.col("sheet_name") == "Arm B") & (F.col("row_idx") % 3 == 0), F.expr("substring(text, 1, cast(length(text) / 2 as int))")).otherwise(F.col("text"))
    path = _fresh(g, "grids")
    g.withColumn("text", text).select(cut.alias("value")).write.text(path)
    rows, rejected = readers.read_grids(spark, path, "json")
    good = rows.groupBy("workbook_id").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("reason", F.lit(None).cast("string"))
    bad = rejected.groupBy("workbook_id", "reason").agg(F.count(F.lit(1)).alias("n_rows"))
    return good.unionByName(bad)


@register("reader_rules", duckdb_ctes("fx_long", "fx_dist_rules").rstrip() + "," + O_CTX + ",\n" + o_lines("ctx", "A")
          + "\nSELECT " + ", ".join(LINE_COLS) + " FROM lines")
def q_reader_rules(spark, sf_dir):
    """Lines by rule tables that were stored and read back with their ruleset filter."""
    from ledgerflow.operators.rules import apply_dist_rules, classify_rows
    fx = Fixtures(spark, sf_dir)
    path = _fresh(fx.dist_rules, "rules")
    for name in ("dist_rules", "amount_map", "routing_rules"):
        getattr(fx, name).write.parquet(f"{path}/{name}")
    stored = readers.load_rules(spark, path, RULESET)
    return apply_dist_rules(classify_rows(fx.long, scenario_id="A", ruleset_id=RULESET), stored.dist_rules, scenario_id="A").select(*LINE_COLS)


@register("null_cost_table", duckdb_ctes("fx_long") + """
SELECT cpms_id, row_id, CAST(NULL AS DECIMAL(18,2)) AS contract_cost FROM fx_long""")
def q_null_cost_table(spark, sf_dir):
    """Without a cost table every contract cost is NULL."""
    long = Fixtures(spark, sf_dir).long
    missing = readers.read_cost_table(spark, f"{sf_dir}/no_such_cost_table")
    return join_ict_costs(long, missing).select("cpms_id", "row_id", "contract_cost")


# ---------------------------------------------------------------------------
# C3 -> C4 -> C5: the whole chain from raw grids to import templates

@register("workbook_templates")
def q_workbook_templates(spark, sf_dir):
    """One run from uploaded grids to import templates, every workbook at once."""
    from ledgerflow.plans import pipeline
    return pipeline.run(grid_df(spark, sf_dir), rule_tables(Fixtures(spark, sf_dir)), scenario_id="A", strict=False)
