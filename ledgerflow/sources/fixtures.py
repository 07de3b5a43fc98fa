"""Views that shape the driver's TPC-H-like tables into costing inputs.

One text per view serves both engines: ``ARRAY_OF(`` becomes ``array(`` in
Spark and ``list_value(`` in DuckDB, ``UNNEST_OF(`` (closed by ``))``)
becomes ``explode(array(`` / ``unnest(list_value(``, ``ELEM(x, n)`` becomes
``element_at(x, n)`` / ``x[n]``.  Spark builds the views with ``spark.sql``
over the parquet scans, so every operator downstream reads data that grows
with the driver tables; DuckDB gets the same text as CTEs in the oracle.

Window row numbers are cast to BIGINT so both engines agree on types.
Study = ``o_custkey``; the total order of lines is
``(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)`` (the
first four repeat once at sf0.001).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

FX_BASE = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       CAST(o_custkey AS STRING) AS cpms_id, 'Study ' || CAST(o_custkey AS STRING) AS study_name,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'Arm A'
            WHEN o_orderpriority = '2-HIGH' THEN 'Arm B'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'Setup & Closedown'
            WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_custkey % 2 = 0 THEN 'Unscheduled Activities'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Arm C'
            WHEN o_custkey % 3 = 0 THEN 'Pharmacy'
            ELSE 'Arm D' END AS sheet_name,
       p_name, p_type, p_size, s_name, n_name
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
"""

_MARK = ("CASE WHEN l_tax = 0.08 THEN NULL WHEN l_linenumber {cmp} THEN CAST(l_partkey % 3 + 1 AS STRING) "
         "WHEN (l_suppkey + {i}) % 4 = 0 THEN '1' WHEN (l_partkey + {i}) % 11 = 0 THEN 'N/A' END")

_ROW_IDX = """CAST(4 + row_number() OVER (PARTITION BY cpms_id, sheet_name
                                   ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS BIGINT) AS row_idx"""

FX_ROWS = """
SELECT cpms_id, study_name, sheet_name,
       """ + _ROW_IDX + """,
       CASE WHEN l_quantity = 1 THEN 'Scheduled / Some Participants'
            WHEN l_quantity = 2 THEN 'Scheduled / All Participants'
            WHEN l_quantity = 3 THEN 'Unscheduled / Itemised Activities'
            WHEN l_quantity = 4 THEN 'Activity'
            WHEN l_quantity = 50 THEN NULL
            ELSE p_name END AS activity,
       CASE p_type WHEN 'ECONOMY' THEN ' Investigation ' WHEN 'PROMO' THEN 'Lab INVESTIGATION'
                   WHEN 'LARGE' THEN NULL ELSE 'Procedure' END AS activity_type,
       CASE WHEN p_size % 5 = 0 THEN 'Pharmacy' WHEN p_size = 1 THEN NULL ELSE 'Research' END AS department,
       CASE l_returnflag WHEN 'A' THEN ' Medical Staff' WHEN 'N' THEN 'Nurse' ELSE NULL END AS staff_role,
       CASE WHEN l_discount = 0 THEN '' ELSE '£' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS activity_cost,
       ARRAY_OF(
         """ + _MARK.format(cmp="= 1", i=1) + """,
         """ + _MARK.format(cmp="= 2", i=2) + """,
         """ + _MARK.format(cmp="= 3", i=3) + """,
         """ + _MARK.format(cmp=">= 4", i=4) + """
       ) AS marks,
       CAST(CAST(l_extendedprice * 3 AS DECIMAL(18,2)) AS STRING) AS total_activity_cost
FROM fx_base
"""

FX_GRID = """
WITH sheets AS (SELECT DISTINCT cpms_id, study_name, sheet_name FROM fx_rows),
pos AS (SELECT *, CAST(row_number() OVER (PARTITION BY cpms_id ORDER BY sheet_name) AS BIGINT) AS sheet_pos FROM sheets),
body AS (
  SELECT cpms_id, sheet_name, CAST(1 AS BIGINT) AS row_idx, ARRAY_OF(' Study ', study_name, CAST(NULL AS STRING)) AS cells FROM sheets
  UNION ALL
  SELECT cpms_id, sheet_name, 2, ARRAY_OF('Study Id', ' ' || cpms_id || ' ', CAST(NULL AS STRING)) FROM sheets
  UNION ALL
  SELECT cpms_id, sheet_name, 3, ARRAY_OF('notes', 'not a table', CAST(NULL AS STRING)) FROM sheets
  UNION ALL
  SELECT cpms_id, sheet_name, 4, ARRAY_OF('Activity', 'Activity Type', 'Department', 'Staff Role', 'Activity Cost',
         CASE WHEN sheet_name = 'Pharmacy' THEN 'Day 30' ELSE 'Screening' END, 'Day 30', CASE WHEN sheet_name = 'Arm B' THEN 'Day 30' ELSE '1st review' END,
         CASE WHEN sheet_name = 'Pharmacy' THEN 'Day 30.1' ELSE 'Follow-up' END, 'Total Activity Cost') FROM sheets
  UNION ALL
  SELECT cpms_id, sheet_name, row_idx, ARRAY_OF(activity, activity_type, department, staff_role, activity_cost,
         ELEM(marks, 1), ELEM(marks, 2), ELEM(marks, 3), ELEM(marks, 4), total_activity_cost) FROM fx_rows
  UNION ALL
  SELECT cpms_id, sheet_name, MAX(row_idx) + 1, ARRAY_OF(CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING),
         'Total Including MFF', '1000.5', '2000.25', '333', '1', CAST(NULL AS STRING)) FROM fx_rows GROUP BY cpms_id, sheet_name)
SELECT body.cpms_id, body.sheet_name, pos.sheet_pos, body.row_idx, body.cells
FROM body JOIN pos ON body.cpms_id = pos.cpms_id AND body.sheet_name = pos.sheet_name
"""

FX_LONG = """
SELECT cpms_id, study_name, sheet_name,
       CAST(row_number() OVER (PARTITION BY cpms_id ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS BIGINT) AS row_id,
       CASE WHEN sheet_name = 'Setup & Closedown' THEN 'SC'
            WHEN sheet_name = 'Unscheduled Activities' THEN 'UA'
            WHEN sheet_name = 'Pharmacy' AND l_linenumber % 2 = 1 THEN 'Arm A'
            WHEN l_quantity > 45 AND sheet_name <> 'Pharmacy' THEN 'SSP'
            ELSE sheet_name END AS study_arm,
       CASE WHEN sheet_name = 'Pharmacy' AND l_linenumber % 2 = 1 THEN 'Arm A' ELSE sheet_name END AS source_sheet,
       p_name AS activity,
       'VISIT - 00' || CAST(l_linenumber AS STRING) AS visit,
       'Day.' || CAST(l_linenumber * 10 AS STRING) AS visit_label,
       CAST(l_suppkey % 3 + 1 AS INT) AS staff_group,
       CASE p_type WHEN 'ECONOMY' THEN ' Investigation ' WHEN 'PROMO' THEN 'Lab INVESTIGATION'
                   WHEN 'LARGE' THEN NULL ELSE 'Procedure' END AS activity_type,
       CASE l_returnflag WHEN 'A' THEN ' Medical Staff' WHEN 'N' THEN 'Nurse' ELSE NULL END AS staff_role,
       CASE WHEN l_discount = 0 THEN '' ELSE '£' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS activity_cost,
       CASE WHEN l_quantity = 7 THEN ' TRAINING_FEE ' WHEN l_quantity = 8 THEN '  ' END AS calc_tag,
       s_name AS provider_org, n_name AS pi_org
FROM fx_base
"""

FX_COST = """
SELECT cpms_id, study_name AS study, visit AS visit_number, study_arm, MIN(visit_label) AS visit_label,
       CAST(NULL AS STRING) AS activity_name, CAST(COUNT(*) * 1000.5 AS DECIMAL(18,2)) AS ict_cost,
       CAST(NULL AS INT) AS activity_occurrence_id, CAST(NULL AS INT) AS staff_group, study_arm AS source_sheet
FROM fx_long WHERE study_arm NOT IN ('UA', 'SC', 'SSP') AND CAST(cpms_id AS BIGINT) % 7 <> 0
GROUP BY cpms_id, study_name, visit, study_arm
UNION ALL
SELECT cpms_id, study_name, visit, study_arm, MIN(visit_label), activity,
       CAST(250.5 + staff_group + CASE WHEN source_sheet = 'Arm B' THEN 10 ELSE 0 END AS DECIMAL(18,2)), CAST(1 AS INT), staff_group, source_sheet
FROM fx_long WHERE study_arm IN ('UA', 'SC', 'SSP')
GROUP BY cpms_id, study_name, visit, study_arm, activity, staff_group, source_sheet
"""

# The eight scenario letters; each rule row is repeated per
# scenario by exploding this list (no join).
_SCENARIOS = "UNNEST_OF('A', 'B', 'C', 'D', 'E', 'F', 'G', 'H'))"

# Invented rule contents (no rule database ships with the
# source); vocabulary follows the source's scenarios, categories and buckets.
FX_DIST_RULES = """
SELECT 'COMM_AH_V1' AS ruleset_id, scenario_id, row_category, condition_field, condition_op, condition_value, posting_line_type_id, priority
FROM (SELECT """ + _SCENARIOS + """ AS scenario_id, r.*
      FROM (VALUES
  ('BASELINE', CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), 'DIRECT', 1),
  ('BASELINE', '', NULL, NULL, 'OVERHEAD', 2),
  ('BASELINE', 'is_medic', '=', 'TRUE', 'MEDIC_SHARE', 3),
  ('BASELINE', 'is_medic', '=', 'TRUE', 'DIRECT', 4),
  ('BASELINE', 'grade', '=', '7', 'NEVER', 5),
  ('INVESTIGATION', NULL, NULL, NULL, 'DIRECT', 1),
  ('INVESTIGATION', 'is_medic', '=', 'FALSE', 'SUPPORT', 2),
  ('TRAINING_FEE', NULL, NULL, NULL, 'TRAINING', 1)
      ) AS r(row_category, condition_field, condition_op, condition_value, posting_line_type_id, priority)) AS x
WHERE NOT (scenario_id = 'H' AND row_category = 'TRAINING_FEE')
"""

FX_AMOUNT_MAP = """
SELECT posting_line_type_id, CAST(base_mult AS DECIMAL(9,4)) AS base_mult, CAST(split_mult AS DECIMAL(9,4)) AS split_mult, applies_to_row_category
FROM (VALUES ('DIRECT', 1.0, 0.7, 'BASELINE'), ('OVERHEAD', 0.25, 1.0, 'BASELINE'), ('MEDIC_SHARE', 1.0, 0.3, 'BASELINE'),
             ('SUPPORT', 0.1, 0.5, 'INVESTIGATION'), ('TRAINING', 1.0, 1.0, 'TRAINING_FEE'))
     AS t(posting_line_type_id, base_mult, split_mult, applies_to_row_category)
"""

FX_ROUTING_RULES = """
SELECT 'COMM_AH_V1' AS ruleset_id, scenario_id, condition_field, condition_op, condition_value, posting_line_type_id, destination_bucket, priority
FROM (SELECT """ + _SCENARIOS + """ AS scenario_id, r.*
      FROM (VALUES
  ('is_medic', '=', 'TRUE', 'DIRECT', 'DEST_PI_ORG', 1),
  (CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), 'DIRECT', 'DEST_PROVIDER', 2),
  (NULL, NULL, NULL, 'OVERHEAD', 'DEST_TRUST_OH', 1),
  ('', NULL, NULL, 'MEDIC_SHARE', 'DEST_PI_ORG', 1),
  (NULL, NULL, NULL, 'SUPPORT', 'DEST_SUPPORT', 1),
  (NULL, NULL, NULL, 'TRAINING', 'DEST_RD', 1)
      ) AS r(condition_field, condition_op, condition_value, posting_line_type_id, destination_bucket, priority)) AS x
"""

# What Spark runs for ``fx_grid``: the rows of FX_GRID with the lines dealt once, by study.  The study's lines are
# sorted by sheet, so one sort numbers sheets and rows, and a sheet's first and last line bring its other rows along.
SPARK_GRID = """
WITH dealt AS (SELECT /*+ REPARTITION(cpms_id) */ * EXCEPT (study_name, s_name, n_name) FROM fx_base WHERE cpms_id IS NOT NULL),
placed AS (
  SELECT *, 4 + row_number() OVER lines AS row_idx, lead(true) OVER lines IS NULL AS is_last,
         CAST(dense_rank() OVER (PARTITION BY cpms_id ORDER BY sheet_name) AS BIGINT) AS sheet_pos
  FROM dealt
  WINDOW lines AS (PARTITION BY cpms_id, sheet_name ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)),
fx_rows AS (SELECT sheet_pos, is_last, """ + FX_ROWS.strip().removeprefix("SELECT").replace("study_name, ", "", 1).replace(_ROW_IDX, "CAST(row_idx AS BIGINT) AS row_idx").replace("FROM fx_base", "FROM placed") + """),
held AS (
  SELECT cpms_id, sheet_name, sheet_pos, explode(concat(
    CASE WHEN row_idx = 5 THEN array(
      struct(CAST(1 AS BIGINT) AS row_idx, array(' Study ', 'Study ' || cpms_id, CAST(NULL AS STRING)) AS cells),
      struct(CAST(2 AS BIGINT) AS row_idx, array('Study Id', ' ' || cpms_id || ' ', CAST(NULL AS STRING)) AS cells),
      struct(CAST(3 AS BIGINT) AS row_idx, array('notes', 'not a table', CAST(NULL AS STRING)) AS cells),
      struct(CAST(4 AS BIGINT) AS row_idx, array('Activity', 'Activity Type', 'Department', 'Staff Role', 'Activity Cost',
             CASE WHEN sheet_name = 'Pharmacy' THEN 'Day 30' ELSE 'Screening' END, 'Day 30', CASE WHEN sheet_name = 'Arm B' THEN 'Day 30' ELSE '1st review' END,
             CASE WHEN sheet_name = 'Pharmacy' THEN 'Day 30.1' ELSE 'Follow-up' END, 'Total Activity Cost') AS cells)) ELSE array() END,
    array(struct(row_idx, array(activity, activity_type, department, staff_role, activity_cost,
                                marks[0], marks[1], marks[2], marks[3], total_activity_cost) AS cells)),
    CASE WHEN is_last THEN array(struct(row_idx + 1 AS row_idx, array(CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING),
             'Total Including MFF', '1000.5', '2000.25', '333', '1', CAST(NULL AS STRING)) AS cells)) ELSE array() END)) AS r
  FROM fx_rows)
SELECT cpms_id, sheet_name, sheet_pos, r.row_idx, r.cells FROM held
"""

# What Spark runs for ``fx_long``: FX_LONG with the lines dealt by study before their texts are made.
SPARK_LONG = FX_LONG.replace("cpms_id, study_name,", "cpms_id, 'Study ' || cpms_id AS study_name,", 1).replace("FROM fx_base", """FROM (
  SELECT /*+ REPARTITION(cpms_id) */ cpms_id, sheet_name, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
         l_discount, l_returnflag, p_name, p_type, s_name, n_name
  FROM fx_base)""")

# name -> (text, views it reads)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "fx_base": (FX_BASE, ()),
    "fx_rows": (FX_ROWS, ("fx_base",)),
    "fx_grid": (FX_GRID, ("fx_rows",)),
    "fx_long": (FX_LONG, ("fx_base",)),
    "fx_cost": (FX_COST, ("fx_long",)),
    "fx_dist_rules": (FX_DIST_RULES, ()),
    "fx_amount_map": (FX_AMOUNT_MAP, ()),
    "fx_routing_rules": (FX_ROUTING_RULES, ()),
}

# Other text, and views, that give Spark the same rows of a view; stored in buckets by study.
SPARK_VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {"fx_grid": (SPARK_GRID, ("fx_base",)), "fx_long": (SPARK_LONG, ("fx_base",))}


def dialect(sql: str, engine: str) -> str:
    if engine == "spark":
        sql = sql.replace("UNNEST_OF(", "explode(array(")
        sql = sql.replace("ARRAY_OF(", "array(")
        return re.sub(r"ELEM\((\w+), (\d+)\)", r"element_at(\1, \2)", sql)
    sql = sql.replace("UNNEST_OF(", "unnest(list_value(")
    sql = sql.replace("ARRAY_OF(", "list_value(")
    return re.sub(r"ELEM\((\w+), (\d+)\)", r"\1[\2]", sql)


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for dep in VIEWS[n][1]:
            visit(dep)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def duckdb_ctes(*names: str) -> str:
    """``WITH`` prefix defining the named views (and what they read) for DuckDB."""
    parts = [f"{n} AS ({dialect(VIEWS[n][0], 'duckdb')})" for n in _closure(names)]
    return "WITH " + ",\n".join(parts) + "\n"


def register_base_tables(spark: SparkSession, sf_dir: str) -> None:
    for t in BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Resolve one view over ``sf_dir``; the returned plan is bound to that scan."""
    views = _closure([name])
    if "fx_base" in views:
        register_base_tables(spark, sf_dir)
    for n in views:
        spark.sql(dialect(VIEWS[n][0], "spark")).createOrReplaceTempView(n)
    return spark.table(name)


# Views materialised once per session and directory: they stand in for the
# stored input tables (long rows, cost table, grids) of a real deployment.
MATERIALIZED = ("fx_base", "fx_long", "fx_cost", "fx_rows", "fx_grid")
_CACHE: dict[tuple[str, str, str], DataFrame] = {}


def materialized(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Write a view once per session and directory; dependents are built on
    the written tables of their inputs, not on their SQL again."""
    from ledgerflow.sources.stage import materialize, materialize_dealt, tasks_for

    ck = (spark.sparkContext.applicationId, sf_dir, name)
    if ck in _CACHE:
        return _CACHE[ck]
    text, deps = SPARK_VIEWS.get(name, VIEWS[name])
    if not deps or name in SPARK_VIEWS:
        register_base_tables(spark, sf_dir)
    if name in SPARK_VIEWS:
        # Read once, by study: what no other view has stored yet is not written for it.
        for d in deps:
            stored = _CACHE.get((*ck[:2], d))
            (spark.sql(dialect(VIEWS[d][0], "spark")) if stored is None else stored).createOrReplaceTempView(d)
        tasks = tasks_for(spark, spark.table("lineitem").count())
        df = materialize_dealt(spark.sql(dialect(text.replace("REPARTITION(", f"REPARTITION({tasks}, "), "spark")), name, "cpms_id", tasks)
    else:
        for d in deps:
            materialized(spark, sf_dir, d).createOrReplaceTempView(d)
        df = spark.sql(dialect(text, "spark"))
        # What is made by study of lines in buckets by study is stored so as well.
        df = materialize_dealt(df, name, "cpms_id") if name == "fx_cost" else materialize(df, name)
    _CACHE[ck] = df
    return df


class Fixtures:
    """All views of one scale-factor directory.

    Input views are written once per session to the checkpoint folder and
    read back as plain parquet tables; rule tables stay inline.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize

    def __getattr__(self, name: str) -> DataFrame:
        key = name if name.startswith("fx_") else f"fx_{name}"
        if key not in VIEWS:
            raise AttributeError(name)
        if not (self.materialize and key in MATERIALIZED):
            # The plan is analysed (bound to this directory's scans) right here.
            return fixture(self.spark, self.sf_dir, key)
        return materialized(self.spark, self.sf_dir, key)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
