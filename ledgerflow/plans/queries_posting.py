"""Posting-plan queries (classification, rules, pricing, routing, costs) on
the ``fx_long`` rows derived from the driver tables.

Oracles evaluate the rule condition row by row and look costs and routes up
with correlated subqueries; the Spark side resolves rule tables once and
uses equi-joins.  The two formulations must agree.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.operators import costjoin, rules
from ledgerflow.operators.allocate import adjust_posting_lines
from ledgerflow.plans.pipeline import RuleTables, plan_by_study, posting_plan
from ledgerflow.plans.registry import register
from ledgerflow.sources.fixtures import Fixtures, duckdb_ctes

RULESET = "COMM_AH_V1"
SCENARIO = "A"


def rule_tables(fx: Fixtures) -> RuleTables:
    return RuleTables(fx.dist_rules, fx.amount_map, fx.routing_rules)


def stored_plan(fx: Fixtures, name: str, step=lambda plan, known: plan, scenario: str = SCENARIO):
    """``step`` of the posting plan of the stored lines, by study where they are dealt so."""
    return plan_by_study(fx.long, rule_tables(fx), fx.cost, name, step, scenario_id=scenario, strict=False)


def _ctx(spark, sf_dir, scenario=SCENARIO):
    fx = Fixtures(spark, sf_dir)
    return fx, rules.classify_rows(fx.long, scenario_id=scenario, ruleset_id=RULESET)


# ---------------------------------------------------------------------------
# Oracle building blocks (DuckDB SQL text).

TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def _trim(c):
    return TRIM.format(c)


O_CTX = f"""ctx AS (
  SELECT * REPLACE (NULLIF({_trim('calc_tag')}, '') AS calc_tag),
         lower({_trim('activity_type')}) AS activity_type_norm,
         lower({_trim('staff_role')}) AS staff_role_norm,
         CASE WHEN activity_type IS NULL THEN NULL
              WHEN strpos(lower({_trim('activity_type')}), 'investigation') > 0 THEN 'INVESTIGATION'
              ELSE 'BASELINE' END AS row_category_auto,
         COALESCE(NULLIF({_trim('calc_tag')}, ''),
                  CASE WHEN activity_type IS NULL THEN NULL
                       WHEN strpos(lower({_trim('activity_type')}), 'investigation') > 0 THEN 'INVESTIGATION'
                       ELSE 'BASELINE' END) AS row_category,
         {_trim('staff_role')} = 'Medical Staff' AS is_medic
  FROM fx_long)"""


def o_passes(alias: str, medic: str) -> str:
    return (f"CASE WHEN {alias}.condition_field IS NULL OR {alias}.condition_field = '' THEN TRUE "
            f"WHEN {alias}.condition_field = 'is_medic' AND {alias}.condition_op = '=' "
            f"AND {alias}.condition_value IN ('TRUE', 'FALSE') THEN {medic} = ({alias}.condition_value = 'TRUE') "
            f"ELSE FALSE END")


def o_costed(src: str = "ctx") -> str:
    return f"""costed AS (
  SELECT x.*, COALESCE(
    (SELECT MAX(f.ict_cost) FROM fx_cost f WHERE f.activity_name IS NOT NULL
       AND f.cpms_id IS NOT DISTINCT FROM x.cpms_id AND f.source_sheet IS NOT DISTINCT FROM x.source_sheet
       AND f.visit_number IS NOT DISTINCT FROM x.visit AND f.study_arm IS NOT DISTINCT FROM x.study_arm
       AND f.activity_name IS NOT DISTINCT FROM x.activity AND f.staff_group IS NOT DISTINCT FROM x.staff_group),
    (SELECT MAX(f.ict_cost) FROM fx_cost f WHERE f.activity_name IS NULL
       AND f.cpms_id IS NOT DISTINCT FROM x.cpms_id AND f.visit_number IS NOT DISTINCT FROM x.visit
       AND f.study_arm IS NOT DISTINCT FROM x.study_arm)) AS contract_cost
  FROM {src} x)"""


def o_lines(src: str, scenario: str | None) -> str:
    scen = f"AND r.scenario_id = '{scenario}'" if scenario else ""
    return f"""lines AS (
  SELECT c.*, r.scenario_id, r.posting_line_type_id,
         TRY_CAST(regexp_replace(c.activity_cost, '[^0-9.]', '', 'g') AS DOUBLE) AS activity_cost_num
  FROM {src} c
  JOIN (SELECT DISTINCT scenario_id, row_category, condition_field, condition_op, condition_value, posting_line_type_id
        FROM fx_dist_rules WHERE ruleset_id = '{RULESET}') r
    ON r.row_category = c.row_category {scen}
  WHERE {o_passes('r', 'c.is_medic')}
  QUALIFY row_number() OVER (PARTITION BY c.cpms_id, c.row_id, r.scenario_id, r.posting_line_type_id) = 1)"""


def o_priced(src: str = "lines", amap: str = "fx_amount_map") -> str:
    return f"""priced AS (
  SELECT l.*, m.base_mult, m.split_mult,
         (m.base_mult IS NULL OR m.split_mult IS NULL) AS missing_amount_map,
         CAST(l.activity_cost_num * CAST(1.08 AS DOUBLE) * CAST(m.base_mult AS DOUBLE) * CAST(m.split_mult AS DOUBLE)
              AS DECIMAL(18,6)) AS posting_amount
  FROM {src} l LEFT JOIN {amap} m ON m.posting_line_type_id = l.posting_line_type_id)"""


def o_routed(src: str = "priced", routing: str = "fx_routing_rules") -> str:
    return f"""routed AS (
  SELECT p.*,
    (SELECT arg_min(rr.destination_bucket, (rr.priority, rr.destination_bucket)) FROM {routing} rr
      WHERE rr.ruleset_id = '{RULESET}' AND rr.scenario_id = p.scenario_id
        AND rr.posting_line_type_id = p.posting_line_type_id AND {o_passes('rr', 'p.is_medic')}) AS destination_bucket
  FROM {src} p)"""


O_ENTITY = """entity AS (
  SELECT *, CASE destination_bucket WHEN 'DEST_PROVIDER' THEN provider_org WHEN 'DEST_PI_ORG' THEN pi_org
                 WHEN 'DEST_RD' THEN 'R&D' WHEN 'DEST_TRUST_OH' THEN 'TRUST_OVERHEAD'
                 WHEN 'DEST_SUPPORT' THEN 'SUPPORT_BUCKET' ELSE 'UNKNOWN' END AS destination_entity,
         CAST(NULL AS VARCHAR) AS cost_code
  FROM routed)"""

PLAN_COLS = ", ".join(list(rules.PLAN_CORE) + ["sheet_name", "visit_label", "staff_group", "contract_cost"])
PLAN_COLS_NO_COST = ", ".join(list(rules.PLAN_CORE) + ["sheet_name", "visit_label", "staff_group"])


def o_plan(scenario: str | None, costed: bool = True) -> str:
    """``WITH`` chain ending in a ``plan`` CTE (the posting plan)."""
    src = "costed" if costed else "ctx"
    parts = [O_CTX] + ([o_costed()] if costed else []) + [o_lines(src, scenario), o_priced(), o_routed(),
                                                           O_ENTITY, f"plan AS (SELECT {PLAN_COLS if costed else PLAN_COLS_NO_COST} FROM entity)"]
    fx = ("fx_long", "fx_cost", "fx_dist_rules", "fx_amount_map", "fx_routing_rules") if costed else \
        ("fx_long", "fx_dist_rules", "fx_amount_map", "fx_routing_rules")
    return duckdb_ctes(*fx).rstrip() + ",\n" + ",\n".join(parts) + "\n"


# ---------------------------------------------------------------------------
# P15 / P16 / P19

@register("classify_rows", duckdb_ctes("fx_long") + "," + O_CTX + """
SELECT cpms_id, row_id, activity_type_norm, staff_role_norm, row_category_auto, calc_tag, row_category, is_medic,
       'A' AS scenario_id, 'COMM_AH_V1' AS ruleset_id FROM ctx""")
def q_classify_rows(spark, sf_dir):
    _, ctx = _ctx(spark, sf_dir)
    return ctx.select("cpms_id", "row_id", "activity_type_norm", "staff_role_norm", "row_category_auto",
                      "calc_tag", "row_category", "is_medic", "scenario_id", "ruleset_id")


@register("calc_tag_override", duckdb_ctes("fx_long") + "," + O_CTX + """
SELECT cpms_id, row_id, row_category_auto, calc_tag, row_category FROM ctx WHERE calc_tag IS NOT NULL""")
def q_calc_tag_override(spark, sf_dir):
    _, ctx = _ctx(spark, sf_dir)
    return (ctx.filter(F.col("calc_tag").isNotNull())
            .select("cpms_id", "row_id", "row_category_auto", "calc_tag", "row_category"))


@register("parse_currency", duckdb_ctes("fx_long") + """
SELECT cpms_id, row_id, activity_cost,
       TRY_CAST(regexp_replace(activity_cost, '[^0-9.]', '', 'g') AS DOUBLE) AS activity_cost_num FROM fx_long""")
def q_parse_currency(spark, sf_dir):
    from ledgerflow.functions.nulls import parse_currency
    fx = Fixtures(spark, sf_dir)
    return fx.long.select("cpms_id", "row_id", "activity_cost",
                          parse_currency("activity_cost").alias("activity_cost_num"))


# ---------------------------------------------------------------------------
# J4 / J5 / Q4

LINE_COLS = ("cpms_id", "row_id", "scenario_id", "row_category", "is_medic", "posting_line_type_id",
              "activity_cost_num")


@register("rule_match", duckdb_ctes("fx_long", "fx_dist_rules") + "," + O_CTX + ",\n" + o_lines("ctx", "A")
          + "\nSELECT " + ", ".join(LINE_COLS) + " FROM lines")
def q_rule_match(spark, sf_dir):
    fx, ctx = _ctx(spark, sf_dir)
    return rules.apply_dist_rules(ctx, fx.dist_rules, scenario_id=SCENARIO).select(*LINE_COLS)


@register("rule_unmatched", duckdb_ctes("fx_long", "fx_dist_rules") + "," + O_CTX + """
SELECT cpms_id, row_id, row_category, is_medic FROM ctx c
WHERE NOT EXISTS (SELECT 1 FROM fx_dist_rules r WHERE r.ruleset_id = 'COMM_AH_V1' AND r.scenario_id = 'H'
                  AND r.row_category = c.row_category AND """ + o_passes("r", "c.is_medic") + ")")
def q_rule_unmatched(spark, sf_dir):
    """Rows that scenario H turns into no posting line at all."""
    fx, ctx = _ctx(spark, sf_dir, scenario="H")
    return (rules.unmatched_rows(ctx, fx.dist_rules, scenario_id="H")
            .select("cpms_id", "row_id", "row_category", "is_medic"))


@register("rule_condition_medic", duckdb_ctes("fx_long", "fx_dist_rules") + "," + O_CTX + ",\n" + o_lines("ctx", None)
          + """
SELECT scenario_id, row_category, is_medic, posting_line_type_id, COUNT(*) AS n_lines
FROM lines GROUP BY scenario_id, row_category, is_medic, posting_line_type_id""")
def q_rule_condition_medic(spark, sf_dir):
    """Lines per scenario, category, medic flag and type over all scenarios."""
    fx = Fixtures(spark, sf_dir)
    ctx = rules.classify_rows(fx.long, ruleset_id=RULESET)
    lines = rules.apply_dist_rules(ctx, fx.dist_rules)
    return (lines.groupBy("scenario_id", "row_category", "is_medic", "posting_line_type_id")
            .agg(F.count(F.lit(1)).alias("n_lines")))


# ---------------------------------------------------------------------------
# J6 / P21 / J8

_PRICE_COLS = ("cpms_id", "row_id", "scenario_id", "posting_line_type_id", "activity_cost_num",
               "base_mult", "split_mult", "posting_amount")


@register("price_lines", duckdb_ctes("fx_long", "fx_dist_rules", "fx_amount_map") + "," + O_CTX + ",\n"
          + o_lines("ctx", "A") + ",\n" + o_priced() + "\nSELECT " + ", ".join(_PRICE_COLS) + " FROM priced")
def q_price_lines(spark, sf_dir):
    fx, ctx = _ctx(spark, sf_dir)
    lines = rules.apply_dist_rules(ctx, fx.dist_rules, scenario_id=SCENARIO)
    return rules.apply_amount_map(lines, fx.amount_map).select(*_PRICE_COLS)


@register("missing_price", duckdb_ctes("fx_long", "fx_dist_rules", "fx_amount_map") + "," + O_CTX + ",\n"
          + o_lines("ctx", None) + ",\n"
          + o_priced(amap="(SELECT * FROM fx_amount_map WHERE applies_to_row_category = 'BASELINE')") + """
SELECT scenario_id, posting_line_type_id, COUNT(*) AS n_lines FROM priced WHERE missing_amount_map
GROUP BY scenario_id, posting_line_type_id""")
def q_missing_price(spark, sf_dir):
    """Line types left unpriced by a BASELINE-only amount map, per scenario."""
    fx = Fixtures(spark, sf_dir)
    ctx = rules.classify_rows(fx.long, ruleset_id=RULESET)
    lines = rules.apply_dist_rules(ctx, fx.dist_rules)
    amap = fx.amount_map.filter(F.col("applies_to_row_category") == "BASELINE")
    priced = rules.apply_amount_map(lines, amap)
    return (priced.filter("missing_amount_map").groupBy("scenario_id", "posting_line_type_id")
            .agg(F.count(F.lit(1)).alias("n_lines")))


# ---------------------------------------------------------------------------
# J7 / J9 / P22

_ROUTE_COLS = ("cpms_id", "row_id", "scenario_id", "posting_line_type_id", "is_medic", "destination_bucket")


@register("route_lines", duckdb_ctes("fx_long", "fx_dist_rules", "fx_amount_map", "fx_routing_rules") + ","
          + O_CTX + ",\n" + o_lines("ctx", "A") + ",\n" + o_priced() + ",\n" + o_routed()
          + "\nSELECT " + ", ".join(_ROUTE_COLS) + " FROM routed")
def q_route_lines(spark, sf_dir):
    fx, ctx = _ctx(spark, sf_dir)
    lines = rules.apply_dist_rules(ctx, fx.dist_rules, scenario_id=SCENARIO)
    priced = rules.apply_amount_map(lines, fx.amount_map)
    return rules.apply_routing(priced, fx.routing_rules).select(*_ROUTE_COLS)


@register("missing_route", duckdb_ctes("fx_long", "fx_dist_rules", "fx_amount_map", "fx_routing_rules") + ","
          + O_CTX + ",\n" + o_lines("ctx", None) + ",\n" + o_priced() + ",\n"
          + o_routed(routing="(SELECT * FROM fx_routing_rules WHERE priority = 1)") + """
SELECT scenario_id, posting_line_type_id, is_medic, COUNT(*) AS n_lines FROM routed WHERE destination_bucket IS NULL
GROUP BY scenario_id, posting_line_type_id, is_medic""")
def q_missing_route(spark, sf_dir):
    """Lines without a route when only first-priority routing rules exist."""
    fx = Fixtures(spark, sf_dir)
    ctx = rules.classify_rows(fx.long, ruleset_id=RULESET)
    lines = rules.apply_dist_rules(ctx, fx.dist_rules)
    priced = rules.apply_amount_map(lines, fx.amount_map)
    routed = rules.apply_routing(priced, fx.routing_rules.filter(F.col("priority") == 1))
    return (routed.filter(F.col("destination_bucket").isNull())
            .groupBy("scenario_id", "posting_line_type_id", "is_medic")
            .agg(F.count(F.lit(1)).alias("n_lines")))


_ENTITY_COLS = ("cpms_id", "row_id", "scenario_id", "posting_line_type_id", "destination_bucket",
                "destination_entity", "cost_code")


def ranked_routing(routing):
    """The routing rules with a place in their table, two more of equal
    priority for each, and priorities of 2 left out."""
    base = routing.withColumn("priority", F.when(F.col("priority") != 2, F.col("priority")))
    late = base.select(*[F.lit("DEST_LATE").alias(c) if c == "destination_bucket" else F.col(c) for c in base.columns], F.lit(2).cast("long").alias("rule_no"))
    early = base.select(*[F.lit("DEST_Z_EARLY").alias(c) if c == "destination_bucket" else F.col(c) for c in base.columns], F.lit(1).cast("long").alias("rule_no"))
    return late.unionByName(early).unionByName(base.withColumn("rule_no", F.lit(None).cast("long")))


_RANKED = """(SELECT r.* EXCLUDE (priority, destination_bucket), CASE WHEN priority <> 2 THEN priority END AS priority,
    COALESCE(x.b, r.destination_bucket) AS destination_bucket, x.no AS rule_no
  FROM fx_routing_rules r, (VALUES ('DEST_LATE', 2), ('DEST_Z_EARLY', 1), (NULL, NULL)) x(b, no))"""


@register("route_ties", duckdb_ctes("fx_long", "fx_dist_rules", "fx_amount_map", "fx_routing_rules") + ","
          + O_CTX + ",\n" + o_lines("ctx", "A") + ",\n" + o_priced() + f""",
ranked AS (SELECT p.cpms_id, p.row_id, p.scenario_id, p.posting_line_type_id, p.is_medic, rr.destination_bucket,
    row_number() OVER (PARTITION BY p.cpms_id, p.row_id, p.scenario_id, p.posting_line_type_id
                       ORDER BY rr.priority NULLS LAST, rr.rule_no NULLS LAST, rr.destination_bucket) AS place
  FROM priced p LEFT JOIN {_RANKED} rr ON rr.ruleset_id = '{RULESET}' AND rr.scenario_id = p.scenario_id
    AND rr.posting_line_type_id = p.posting_line_type_id AND {o_passes('rr', 'p.is_medic')})
SELECT """ + ", ".join(_ROUTE_COLS) + " FROM ranked WHERE place = 1")
def q_route_ties(spark, sf_dir):
    """Routing with equal and missing priorities: table order decides, missing ones come last."""
    fx, ctx = _ctx(spark, sf_dir)
    priced = rules.apply_amount_map(rules.apply_dist_rules(ctx, fx.dist_rules, scenario_id=SCENARIO), fx.amount_map)
    return rules.apply_routing(priced, ranked_routing(fx.routing_rules)).select(*_ROUTE_COLS)


@register("amount_map_dups", duckdb_ctes("fx_long", "fx_dist_rules", "fx_amount_map") + "," + O_CTX + ",\n" + o_lines("ctx", "A") + """,
twice AS (SELECT * FROM fx_amount_map UNION ALL SELECT * FROM fx_amount_map WHERE applies_to_row_category = 'BASELINE'),
dup AS (SELECT posting_line_type_id, COUNT(*) AS n FROM twice GROUP BY posting_line_type_id HAVING COUNT(*) > 1)
SELECT l.posting_line_type_id, COUNT(*) AS n_lines, CAST(SUM(d.n) AS BIGINT) AS n_multiplied
FROM lines l JOIN dup d ON d.posting_line_type_id = l.posting_line_type_id GROUP BY l.posting_line_type_id""")
def q_amount_map_dups(spark, sf_dir):
    """Lines that an amount map with repeated line types would multiply."""
    fx, ctx = _ctx(spark, sf_dir)
    lines = rules.apply_dist_rules(ctx, fx.dist_rules, scenario_id=SCENARIO)
    twice = fx.amount_map.unionByName(fx.amount_map.filter(F.col("applies_to_row_category") == "BASELINE"))
    dups = rules.amount_map_fanout(twice)
    return lines.join(dups, "posting_line_type_id").groupBy("posting_line_type_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("count").alias("n_multiplied"))


@register("entity_map", duckdb_ctes("fx_long", "fx_dist_rules", "fx_amount_map", "fx_routing_rules") + ","
          + O_CTX + ",\n" + o_lines("ctx", "A") + ",\n" + o_priced() + ",\n" + o_routed() + ",\n" + O_ENTITY
          + "\nSELECT " + ", ".join(_ENTITY_COLS) + " FROM entity")
def q_entity_map(spark, sf_dir):
    fx, ctx = _ctx(spark, sf_dir)
    lines = rules.apply_dist_rules(ctx, fx.dist_rules, scenario_id=SCENARIO)
    routed = rules.apply_routing(rules.apply_amount_map(lines, fx.amount_map), fx.routing_rules)
    return rules.resolve_entities(routed).select(*_ENTITY_COLS)


# ---------------------------------------------------------------------------
# C4 / C7 / S8

@register("posting_plan", o_plan("A") + "SELECT * FROM plan")
def q_posting_plan(spark, sf_dir):
    return stored_plan(Fixtures(spark, sf_dir), "posting_plan")


@register("scenario_matrix", o_plan(None) + "SELECT * FROM plan")
def q_scenario_matrix(spark, sf_dir):
    """All eight scenarios in one job: scenario is a column, not a loop."""
    fx = Fixtures(spark, sf_dir)
    return posting_plan(fx.long, rule_tables(fx), cost_table=fx.cost, strict=False)


@register("scenario_list", o_plan(None, costed=False) + """
SELECT scenario_id, COUNT(*) AS n_lines, COUNT(DISTINCT cpms_id) AS n_studies FROM plan GROUP BY scenario_id""")
def q_scenario_list(spark, sf_dir):
    """Scenarios present in the plan, with their line and study counts."""
    fx = Fixtures(spark, sf_dir)
    plan = posting_plan(fx.long, rule_tables(fx), with_costs=False, strict=False)
    per_study = plan.groupBy("scenario_id", "cpms_id").agg(F.count(F.lit(1)).alias("n"))
    return (per_study.groupBy("scenario_id")
            .agg(F.sum("n").alias("n_lines"), F.count(F.lit(1)).alias("n_studies"))
            .orderBy("scenario_id"))


# ---------------------------------------------------------------------------
# J1 / J2 / J3 / J14 / Q5 / Q8

_COST_COLS = ("cpms_id", "row_id", "source_sheet", "visit", "study_arm", "activity", "staff_group")


@register("cost_join_activity", duckdb_ctes("fx_long", "fx_cost") + """
SELECT x.cpms_id, x.row_id, x.source_sheet, x.visit, x.study_arm, x.activity, x.staff_group,
  (SELECT MAX(f.ict_cost) FROM fx_cost f WHERE f.activity_name IS NOT NULL
     AND f.cpms_id IS NOT DISTINCT FROM x.cpms_id AND f.source_sheet IS NOT DISTINCT FROM x.source_sheet
     AND f.visit_number IS NOT DISTINCT FROM x.visit AND f.study_arm IS NOT DISTINCT FROM x.study_arm
     AND f.activity_name IS NOT DISTINCT FROM x.activity AND f.staff_group IS NOT DISTINCT FROM x.staff_group)
  AS contract_cost_activity
FROM fx_long x""")
def q_cost_join_activity(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return costjoin.join_activity_costs(fx.long.select(*_COST_COLS), fx.cost)


@register("cost_join_visit", duckdb_ctes("fx_long", "fx_cost") + """
SELECT x.cpms_id, x.row_id, x.source_sheet, x.visit, x.study_arm, x.activity, x.staff_group,
  (SELECT MAX(f.ict_cost) FROM fx_cost f WHERE f.activity_name IS NULL
     AND f.cpms_id IS NOT DISTINCT FROM x.cpms_id AND f.visit_number IS NOT DISTINCT FROM x.visit
     AND f.study_arm IS NOT DISTINCT FROM x.study_arm) AS contract_cost_visit
FROM fx_long x""")
def q_cost_join_visit(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return costjoin.join_visit_costs(fx.long.select(*_COST_COLS), fx.cost)


@register("cost_join_two_level", duckdb_ctes("fx_long", "fx_cost") + ",\n" + o_costed("fx_long").replace(
    "SELECT x.*,", "SELECT x.cpms_id, x.row_id, x.source_sheet, x.visit, x.study_arm, x.activity, x.staff_group,")
    + "\nSELECT * FROM costed")
def q_cost_join_two_level(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return costjoin.join_ict_costs(fx.long.select(*_COST_COLS), fx.cost)


@register("cost_dup_audit", duckdb_ctes("fx_long", "fx_cost") + """
SELECT cpms_id, visit_number, study_arm, activity_name, staff_group,
       COUNT(*) AS n_rows, COUNT(DISTINCT ict_cost) AS n_costs
FROM fx_cost WHERE activity_name IS NOT NULL
GROUP BY cpms_id, visit_number, study_arm, activity_name, staff_group HAVING COUNT(*) > 1""")
def q_cost_dup_audit(spark, sf_dir):
    """Cost keys that repeat under the five-key join (same activity in two arm sheets)."""
    fx = Fixtures(spark, sf_dir)
    return costjoin.cost_dup_audit(fx.cost)


@register("uncosted_audit", duckdb_ctes("fx_long", "fx_cost") + ",\n" + o_costed("fx_long") + """
SELECT cpms_id, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE contract_cost IS NULL) AS n_uncosted
FROM costed GROUP BY cpms_id""")
def q_uncosted_audit(spark, sf_dir):
    """Per study: source rows, and rows that found no contract cost."""
    fx = Fixtures(spark, sf_dir)
    costed = costjoin.join_ict_costs(fx.long, fx.cost)
    return costed.groupBy("cpms_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.count(F.when(F.col("contract_cost").isNull(), 1)).alias("n_uncosted"))


@register("label_enrich", duckdb_ctes("fx_long", "fx_cost") + """
SELECT x.cpms_id, x.row_id, x.study_arm, x.visit,
       COALESCE((SELECT MIN(f.visit_label) FROM fx_cost f WHERE f.cpms_id IS NOT DISTINCT FROM x.cpms_id
                 AND f.study_arm IS NOT DISTINCT FROM x.study_arm AND f.visit_number IS NOT DISTINCT FROM x.visit),
                x.visit) AS visit_label
FROM fx_long x""")
def q_label_enrich(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    rows = fx.long.select("cpms_id", "row_id", "study_arm", "visit")
    return costjoin.enrich_labels(rows, fx.cost)


# ---------------------------------------------------------------------------
# W13 / Q3 on the posting plan

_ALLOC_PLAN_COLS = ("cpms_id", "row_id", "scenario_id", "posting_line_type_id", "posting_amount",
                    "contract_price", "base_sum", "multiplier", "adjusted_amount", "residual",
                    "is_residual_row", "adjusted_sum_check", "diff_check")


def _plan_lines_cte(scenario):
    return o_plan(scenario).rstrip() + """,
lines2 AS (SELECT cpms_id, row_id, scenario_id, posting_line_type_id, posting_amount, contract_cost FROM plan)"""


def _alloc_plan_oracle(group, scenario="A"):
    from ledgerflow.plans.queries_alloc import alloc_oracle
    body = alloc_oracle(_plan_lines_cte(scenario), group, ["row_id"], src="lines2")
    return "SELECT " + ", ".join(_ALLOC_PLAN_COLS) + " FROM (" + body + ") q"


@register("alloc_row_grain", _alloc_plan_oracle(["cpms_id", "scenario_id", "row_id"]))
def q_alloc_row_grain(spark, sf_dir):
    """Older grouping: every source row balanced alone, per scenario."""
    def by_row(plan, known):
        return adjust_posting_lines(plan, grain="row", method="window" if known else "agg").select(*_ALLOC_PLAN_COLS)

    return stored_plan(Fixtures(spark, sf_dir), "alloc_row_grain", by_row)


def _mixed_price_sql():
    from ledgerflow.plans.queries_templates import _dispatch_lines
    return _dispatch_lines() + """
SELECT cpms_id, scenario_id, alloc_class, ka AS key_a, kb AS key_b, kc AS key_c, COUNT(*) AS n_lines,
       COUNT(DISTINCT contract_cost) AS n_prices, MIN(contract_cost) AS min_cost, MAX(contract_cost) AS max_cost
FROM lines2 GROUP BY cpms_id, scenario_id, alloc_class, ka, kb, kc HAVING COUNT(DISTINCT contract_cost) > 1"""


@register("mixed_price_audit")
def q_mixed_price_audit(spark, sf_dir):
    """Q3: allocation groups whose lines carry different contract costs (first wins)."""
    from ledgerflow.operators.allocate import with_alloc_key

    def audit(plan, known):
        keyed = with_alloc_key(plan)
        return (keyed.groupBy("cpms_id", "scenario_id", "alloc_class", "alloc_key")
                .agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("contract_cost").alias("n_prices"),
                     F.min("contract_cost").alias("min_cost"), F.max("contract_cost").alias("max_cost"))
                .filter(F.col("n_prices") > 1)
                .select("cpms_id", "scenario_id", "alloc_class", F.col("alloc_key.a").alias("key_a"),
                        F.col("alloc_key.b").alias("key_b"), F.col("alloc_key.c").alias("key_c"),
                        "n_lines", "n_prices", "min_cost", "max_cost"))

    return stored_plan(Fixtures(spark, sf_dir), "mixed_price_audit", audit)
