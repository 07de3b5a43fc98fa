"""Allocation dispatch, billing keys and import templates on the posting plan
of the ``fx_long`` rows (scenario A, with contract costs).

Oracle: the allocation as grouped subqueries, key numbers as correlated
counts of keys that come earlier, templates as grouped sums.
"""

from __future__ import annotations

from ledgerflow.operators.allocate import adjust_posting_lines
from ledgerflow.operators.keys import assign_edge_keys
from ledgerflow.operators.templates import EDGE_COLUMNS, arm_templates, special_templates, template_counts
from ledgerflow.plans.pipeline import by_study, stored_adjusted_plan, stored_keys, stored_templates
from ledgerflow.plans.queries_alloc import alloc_oracle
from ledgerflow.plans.queries_posting import SCENARIO, o_plan, rule_tables, stored_plan
from ledgerflow.plans.registry import register
from ledgerflow.sources.fixtures import Fixtures

STUDY = ["cpms_id", "scenario_id"]


def adjusted(spark, sf_dir, method="agg", scenario=SCENARIO, stage=False, columns=("*",)):
    """Adjusted posting plan; ``stage=True`` writes it once for its several
    consumers (keys, special and arm templates) instead of recomputing it.
    ``columns``: those of the plan that a caller without ``stage`` reads."""
    fx = Fixtures(spark, sf_dir)
    if stage:
        return stored_adjusted_plan(fx.long, rule_tables(fx), fx.cost, scenario_id=scenario, strict=False)

    def by_method(plan, known):
        return adjust_posting_lines(plan, method=method, dealt_by="cpms_id" if known else None).select(*columns)

    return stored_plan(fx, "adjusted_plan", by_method, scenario)


# ---------------------------------------------------------------------------
# Oracle text

_SPECIAL = "('Unscheduled Activities', 'Setup & Closedown', 'Pharmacy')"
_ADJ_SPECIAL = "('Unscheduled Activities', 'Setup & Closedown')"


def _dispatch_lines(scenario=SCENARIO) -> str:
    return o_plan(scenario).rstrip() + f""",
lines2 AS (
  SELECT *,
    CASE WHEN sheet_name IN {_ADJ_SPECIAL} THEN 'activity' ELSE 'visit' END AS alloc_class,
    CASE WHEN sheet_name IN {_ADJ_SPECIAL} THEN CAST(row_id AS VARCHAR)
         ELSE regexp_replace(CASE WHEN sheet_name = 'Pharmacy' THEN study_arm ELSE sheet_name END, '^\\s+|\\s+$', '', 'g') END AS ka,
    CASE WHEN sheet_name IN {_ADJ_SPECIAL} THEN activity ELSE visit END AS kb,
    CASE WHEN sheet_name IN {_ADJ_SPECIAL} THEN CAST(staff_group AS VARCHAR) END AS kc
  FROM plan)"""


_GROUP = ["cpms_id", "scenario_id", "alloc_class", "ka", "kb", "kc"]
ADJ_SQL = alloc_oracle(_dispatch_lines(), _GROUP, ["row_id"], src="lines2", drop=())

_ADJ_COLS = ("cpms_id", "row_id", "scenario_id", "sheet_name", "study_arm", "visit", "posting_line_type_id",
             "posting_amount", "contract_cost", "contract_price", "base_sum", "multiplier", "adjusted_amount",
             "residual", "is_residual_row", "adjusted_sum_check", "diff_check")

_KEYS = f"""adj AS (SELECT * FROM ({ADJ_SQL}) q),
sk AS (
  SELECT cpms_id, scenario_id, sheet_name, activity, row_id, staff_group, study_arm,
         MIN(CASE WHEN sheet_name IN {_ADJ_SPECIAL} THEN 0 ELSE 1 END) AS part, MIN(row_id) AS fr
  FROM adj WHERE sheet_name IN {_SPECIAL}
  GROUP BY cpms_id, scenario_id, sheet_name, activity, row_id, staff_group, study_arm),
mk AS (
  SELECT cpms_id, scenario_id, study_arm, visit, MIN(row_id) AS fr
  FROM adj WHERE NOT COALESCE(sheet_name IN {_SPECIAL}, FALSE)
  GROUP BY cpms_id, scenario_id, study_arm, visit),
skn AS (
  SELECT a.*, (SELECT COUNT(*) FROM sk b WHERE b.cpms_id = a.cpms_id AND b.scenario_id = a.scenario_id
               AND (b.part < a.part OR (b.part = a.part AND b.fr <= a.fr))) AS seq
  FROM sk a),
mkn AS (
  SELECT a.*, (SELECT COUNT(*) FROM sk b WHERE b.cpms_id = a.cpms_id AND b.scenario_id = a.scenario_id)
            + (SELECT COUNT(*) FROM mk b WHERE b.cpms_id = a.cpms_id AND b.scenario_id = a.scenario_id AND b.fr <= a.fr) AS seq
  FROM mk a)"""


def _with_keys() -> str:
    return "WITH " + _KEYS + "\n"


def _edge_select(name, desc_src, key, total) -> str:
    null = "CAST(NULL AS VARCHAR)"
    vals = (null, name, "'Participant'", null, null,
            f"'VISIT - ' || COALESCE(replace({desc_src}, '.', ' '), 'NA')", key, "'Research Cost'",
            f"CAST({total} AS DECIMAL(18,2))", "'GBP'", null, null, null)
    return ", ".join(f'{v} AS "{c}"' for v, c in zip(vals, EDGE_COLUMNS))


_SPECIAL_T = f"""st AS (
  SELECT t.cpms_id, t.scenario_id, 'special' AS template_kind, t.sheet_name AS template_name,
         {_edge_select('t.study_arm', 't.activity', "printf('EDGE-%04d', k.seq)", 't.total')}
  FROM (SELECT cpms_id, scenario_id, study_arm, sheet_name, activity, row_id, staff_group,
               COALESCE(SUM(adjusted_amount), 0) AS total
        FROM adj WHERE sheet_name IN {_SPECIAL}
        GROUP BY cpms_id, scenario_id, study_arm, sheet_name, activity, row_id, staff_group) t
  LEFT JOIN skn k ON k.cpms_id = t.cpms_id AND k.scenario_id = t.scenario_id AND k.sheet_name = t.sheet_name
       AND k.activity IS NOT DISTINCT FROM t.activity AND k.row_id = t.row_id
       AND k.staff_group IS NOT DISTINCT FROM t.staff_group AND k.study_arm IS NOT DISTINCT FROM t.study_arm)"""

_ARM_T = f"""main AS (
  SELECT * FROM adj WHERE NOT COALESCE(sheet_name IN {_SPECIAL}, FALSE) OR COALESCE(sheet_name = 'Pharmacy', FALSE)),
arm_t AS (
  SELECT t.cpms_id, t.scenario_id, 'arm' AS template_kind, t.study_arm AS template_name,
         {_edge_select('t.study_arm', 't.visit_label', '''(SELECT printf('EDGE-%04d', k.seq) FROM mkn k
             WHERE k.cpms_id = t.cpms_id AND k.scenario_id = t.scenario_id
               AND k.study_arm IS NOT DISTINCT FROM t.study_arm AND k.visit IS NOT DISTINCT FROM t.visit
               AND EXISTS (SELECT 1 FROM main m WHERE m.cpms_id = t.cpms_id AND m.scenario_id = t.scenario_id
                           AND m.study_arm IS NOT DISTINCT FROM t.study_arm AND m.visit IS NOT DISTINCT FROM t.visit
                           AND m.sheet_name <> 'Pharmacy'))''', 't.total')}
  FROM (SELECT cpms_id, scenario_id, study_name, visit, study_arm, visit_label,
               COALESCE(SUM(adjusted_amount), 0) AS total
        FROM main GROUP BY cpms_id, scenario_id, study_name, visit, study_arm, visit_label) t)"""


# ---------------------------------------------------------------------------

def templates_of(adj):
    """All templates from a staged adjusted plan; the key table feeds both
    template kinds, so it is written once too."""
    return stored_templates(adj)


@register("alloc_dispatch", "SELECT " + ", ".join(_ADJ_COLS) + " FROM (" + ADJ_SQL + ") q")
def q_alloc_dispatch(spark, sf_dir):
    """W6 + W7: UA/Setup lines balanced per activity row, all others per visit pool (window form)."""
    return adjusted(spark, sf_dir, method="window", columns=_ADJ_COLS)


@register("alloc_dispatch_agg", "SELECT " + ", ".join(_ADJ_COLS) + " FROM (" + ADJ_SQL + ") q")
def q_alloc_dispatch_agg(spark, sf_dir):
    """Same allocation through the form that splits large groups."""
    return adjusted(spark, sf_dir, method="agg", columns=_ADJ_COLS)


@register("edge_keys", _with_keys() + """
SELECT a.cpms_id, a.row_id, a.scenario_id, a.posting_line_type_id, a.sheet_name, a.study_arm, a.visit,
       COALESCE(
         (SELECT printf('EDGE-%04d', k.seq) FROM skn k WHERE k.cpms_id = a.cpms_id AND k.scenario_id = a.scenario_id
            AND k.sheet_name IS NOT DISTINCT FROM a.sheet_name AND k.activity IS NOT DISTINCT FROM a.activity
            AND k.row_id = a.row_id AND k.staff_group IS NOT DISTINCT FROM a.staff_group
            AND k.study_arm IS NOT DISTINCT FROM a.study_arm),
         (SELECT printf('EDGE-%04d', k.seq) FROM mkn k WHERE k.cpms_id = a.cpms_id AND k.scenario_id = a.scenario_id
            AND k.study_arm IS NOT DISTINCT FROM a.study_arm AND k.visit IS NOT DISTINCT FROM a.visit)) AS edge_key
FROM adj a""")
def q_edge_keys(spark, sf_dir):
    adj = adjusted(spark, sf_dir, stage=True)
    return by_study(adj, [stored_keys(adj)], "keyed_lines", lambda a, keys, known=(): assign_edge_keys(a, keys=keys, known=known).select(
        "cpms_id", "row_id", "scenario_id", "posting_line_type_id", "sheet_name", "study_arm", "visit", "edge_key"))


@register("template_special", _with_keys().rstrip() + ",\n" + _SPECIAL_T + "\nSELECT * FROM st")
def q_template_special(spark, sf_dir):
    adj = adjusted(spark, sf_dir, stage=True)
    return by_study(adj, [stored_keys(adj)], "special_templates", lambda a, keys, known=(): special_templates(a, keys, known=known))


@register("template_arm", _with_keys().rstrip() + ",\n" + _ARM_T + "\nSELECT * FROM arm_t")
def q_template_arm(spark, sf_dir):
    adj = adjusted(spark, sf_dir, stage=True)
    return by_study(adj, [stored_keys(adj)], "arm_templates", lambda a, keys, known=(): arm_templates(a, keys, known=known))


_ALL = _with_keys().rstrip() + ",\n" + _SPECIAL_T + ",\n" + _ARM_T + ",\nallt AS (SELECT * FROM st UNION ALL SELECT * FROM arm_t)\n"


@register("template_all", _ALL + "SELECT * FROM allt")
def q_template_all(spark, sf_dir):
    """C5 end to end: posting plan -> allocation -> keys -> all templates."""
    return templates_of(adjusted(spark, sf_dir, stage=True))


@register("template_counts", _ALL + """
SELECT cpms_id, scenario_id, COUNT(DISTINCT (template_kind, template_name)) AS n_templates,
       COUNT(*) AS n_template_rows, CAST(SUM("Default Cost") AS DECIMAL(18,2)) AS total_default_cost
FROM allt GROUP BY cpms_id, scenario_id""")
def q_template_counts(spark, sf_dir):
    return template_counts(templates_of(adjusted(spark, sf_dir, stage=True)))


_KEYED = """keyed AS (
  SELECT a.*, COALESCE(
      (SELECT printf('EDGE-%04d', k.seq) FROM skn k WHERE k.cpms_id = a.cpms_id AND k.scenario_id = a.scenario_id
         AND k.sheet_name IS NOT DISTINCT FROM a.sheet_name AND k.activity IS NOT DISTINCT FROM a.activity
         AND k.row_id = a.row_id AND k.staff_group IS NOT DISTINCT FROM a.staff_group
         AND k.study_arm IS NOT DISTINCT FROM a.study_arm),
      (SELECT printf('EDGE-%04d', k.seq) FROM mkn k WHERE k.cpms_id = a.cpms_id AND k.scenario_id = a.scenario_id
         AND k.study_arm IS NOT DISTINCT FROM a.study_arm AND k.visit IS NOT DISTINCT FROM a.visit)) AS edge_key
  FROM adj a)"""


def _arm_keyed_sql():
    from ledgerflow.sources.fixtures import VIEWS, dialect
    head = _with_keys().rstrip()
    return head + ",\n" + _KEYED + f""",
fx_base AS ({dialect(VIEWS["fx_base"][0], "duckdb")}),
fx_long_c AS ({dialect(VIEWS["fx_long"][0], "duckdb")}),
fx_cost_c AS ({dialect(VIEWS["fx_cost"][0], "duckdb").replace("FROM fx_long", "FROM fx_long_c")}),
t AS (
  SELECT cpms_id, scenario_id, study_name, visit, study_arm, edge_key, COALESCE(SUM(adjusted_amount), 0) AS total
  FROM keyed WHERE NOT COALESCE(sheet_name IN {_SPECIAL}, FALSE) OR COALESCE(sheet_name = 'Pharmacy', FALSE)
  GROUP BY cpms_id, scenario_id, study_name, visit, study_arm, edge_key)
SELECT t.cpms_id, t.scenario_id, 'arm' AS template_kind, t.study_arm AS template_name,
       {_edge_select('t.study_arm', "COALESCE((SELECT MIN(c.visit_label) FROM fx_cost_c c WHERE c.cpms_id = t.cpms_id AND c.study_arm IS NOT DISTINCT FROM t.study_arm AND c.visit_number IS NOT DISTINCT FROM t.visit), t.visit)", 't.edge_key', 't.total')}
FROM t"""


@register("template_arm_keyed")
def q_template_arm_keyed(spark, sf_dir):
    """Arm totals with the billing key in the grouping, labels from the cost table."""
    from ledgerflow.operators.templates import arm_templates_by_key
    adj = adjusted(spark, sf_dir, stage=True)
    return by_study(adj, [stored_keys(adj), Fixtures(spark, sf_dir).cost], "arm_templates",
                    lambda a, keys, cost, known=(): arm_templates_by_key(assign_edge_keys(a, keys=keys, known=known), cost, known=known))


def _late_oracles():
    from ledgerflow.plans.queries_posting import _mixed_price_sql
    from ledgerflow.plans.registry import ORACLES
    ORACLES["mixed_price_audit"] = _mixed_price_sql()
    ORACLES["template_arm_keyed"] = _arm_keyed_sql()


_late_oracles()
