"""Readers: sheet grids, rule tables, cost table.

All are plain ``spark.read`` scans; filters and projections are written
before any other operator so Catalyst pushes them into the parquet scan
(``PushedFilters`` / ``ReadSchema`` in ``explain``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.plans.pipeline import RuleTables
from ledgerflow.sinks import versions

GRID_SCHEMA = T.StructType([
    T.StructField("workbook_id", T.StringType(), False),
    T.StructField("sheet_name", T.StringType(), False),
    T.StructField("sheet_pos", T.IntegerType(), True),
    T.StructField("row_idx", T.LongType(), False),
    T.StructField("cells", T.ArrayType(T.StringType()), True),
])

_CORRUPT = "_corrupt_record"

DIST_RULE_COLUMNS = ("scenario_id", "row_category", "condition_field", "condition_op", "condition_value",
                     "posting_line_type_id", "priority")
AMOUNT_MAP_COLUMNS = ("posting_line_type_id", "base_mult", "split_mult", "applies_to_row_category")
ROUTING_COLUMNS = ("scenario_id", "condition_field", "condition_op", "condition_value", "posting_line_type_id",
                   "destination_bucket", "priority")
COST_SCAN_COLUMNS = ("cpms_id", "visit_number", "study_arm", "activity_name", "ict_cost", "activity_occurrence_id",
                     "staff_group", "source_sheet", "visit_label")


def read_grids(spark: SparkSession, path: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """S1 + S2: every sheet of every workbook as grid rows (schema ``GRID_SCHEMA``),
    and the rows that cannot be used, with their ``reason`` and, for ``json``
    lines, the ``record`` as it stands in the file.  No row is in neither."""
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in GRID_SCHEMA.fields])
    names = [f.name for f in GRID_SCHEMA.fields]
    if fmt == "parquet":
        rows = spark.read.schema(nullable).parquet(path).withColumns({"record": F.lit(None).cast("string"), "readable": F.lit(True)})
    elif fmt == "json":
        # Line by line, as a reader of JSON files leaves out a line that holds no object.
        typed = T.StructType([*nullable.fields, T.StructField(_CORRUPT, T.StringType())])
        grid = F.from_json("value", typed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
        rows = spark.read.text(path).where(F.trim("value") != "").select(grid.alias("grid"), F.col("value").alias("record"))
        readable = F.col("grid").isNotNull() & F.col(f"grid.{_CORRUPT}").isNull()
        rows = rows.select(*[F.col(f"grid.{c}").alias(c) for c in names], "record", readable.alias("readable"))
    else:
        raise ValueError(f"no reader of grids in {fmt!r}")
    reason = F.when(~F.col("readable"), "unreadable record")
    for column, what in (("workbook_id", "no workbook"), ("sheet_name", "no sheet"), ("row_idx", "no row number")):
        reason = reason.when(F.col(column).isNull(), what)
    rows = rows.withColumn("reason", reason)
    # What a broken record still gave is not to be trusted.
    trusted = [F.when(F.col("readable"), F.col(c)).alias(c) for c in names]
    return rows.filter(F.col("reason").isNull()).select(*names), rows.filter(F.col("reason").isNotNull()).select(*trusted, "reason", "record")


def load_rules(spark: SparkSession, root: str, ruleset_id: str) -> RuleTables:
    """The three rule tables, ruleset filter pushed into the scans."""
    if not os.path.exists(root) and "://" not in root:
        raise FileNotFoundError(f"rule tables not found: {root}")
    dist = (spark.read.parquet(f"{root}/dist_rules").filter(F.col("ruleset_id") == ruleset_id)
            .select("ruleset_id", *DIST_RULE_COLUMNS))
    amap = spark.read.parquet(f"{root}/amount_map").select(*AMOUNT_MAP_COLUMNS)
    route = (spark.read.parquet(f"{root}/routing_rules").filter(F.col("ruleset_id") == ruleset_id)
             .select("ruleset_id", *ROUTING_COLUMNS))
    return RuleTables(dist, amap, route)


def read_cost_table(spark: SparkSession, path: str | None) -> DataFrame | None:
    """S6 + S7: projected scan of the cost table's last version; a missing table
    gives ``None`` (the cost join then yields NULL contract costs)."""
    df = None if path is None else versions.read(spark, path)
    return None if df is None else df.select(*[c for c in COST_SCAN_COLUMNS if c in df.columns])


def scenario_list(dist_rules: DataFrame) -> DataFrame:
    """Distinct scenarios in order (the rule table is configuration)."""
    return dist_rules.select("scenario_id").distinct().orderBy("scenario_id")
