from decimal import Decimal

from ledgerflow.operators import costjoin, rules

RULES = ("ruleset_id string, scenario_id string, row_category string, condition_field string, condition_op string, "
         "condition_value string, posting_line_type_id string, priority int")


def rule_table(spark):
    return spark.createDataFrame([
        ("R", "A", "BASELINE", None, None, None, "DIRECT", 1),
        ("R", "A", "BASELINE", "is_medic", "=", "TRUE", "MEDIC_SHARE", 2),
        ("R", "A", "BASELINE", "is_medic", "=", "FALSE", "NURSE", 3),
        ("R", "A", "BASELINE", "grade", "=", "7", "NEVER", 4),
    ], RULES)


def rows(spark, roles):
    data = [(i, "x", "Procedure", r, "£10.00", None) for i, r in enumerate(roles)]
    return spark.createDataFrame(data, "row_id long, cpms_id string, activity_type string, staff_role string, "
                                       "activity_cost string, calc_tag string")


def test_medic_null_gets_only_unconditional_rules(spark):
    ctx = rules.classify_rows(rows(spark, [" Medical Staff", "Nurse", None]), ruleset_id="R")
    lines = rules.apply_dist_rules(ctx, rule_table(spark), scenario_id="A", ruleset_id="R")
    got = sorted((r.row_id, r.posting_line_type_id) for r in lines.collect())
    assert got == [(0, "DIRECT"), (0, "MEDIC_SHARE"), (1, "DIRECT"), (1, "NURSE"), (2, "DIRECT")]


def test_category_null_when_type_missing_and_override(spark):
    df = spark.createDataFrame([(1, None, " TRAINING_FEE "), (2, None, "  "), (3, "Lab INVESTIGATION", None)],
                               "row_id long, activity_type string, calc_tag string")
    df = df.withColumn("staff_role", df.calc_tag).withColumn("activity_cost", df.calc_tag)
    out = {r.row_id: r for r in rules.classify_rows(df).collect()}
    assert out[1].row_category == "TRAINING_FEE" and out[1].row_category_auto is None
    assert out[2].row_category is None and out[2].calc_tag is None
    assert out[3].row_category == "INVESTIGATION"


COST = ("cpms_id string, study string, visit_number string, study_arm string, visit_label string, "
        "activity_name string, ict_cost decimal(18,2), activity_occurrence_id int, staff_group int, source_sheet string")


def test_null_keys_match_and_sheet_disambiguates(spark):
    cost = spark.createDataFrame([
        ("1", "S", "VISIT - 001", "SSP", None, "Blood", Decimal("10"), 1, None, "Arm A"),
        ("1", "S", "VISIT - 001", "SSP", None, "Blood", Decimal("20"), 1, None, "Arm B"),
        ("1", "S", "VISIT - 001", "Arm A", None, None, Decimal("99"), None, None, "Arm A"),
    ], COST)
    df = spark.createDataFrame([
        (1, "1", "Arm A", "VISIT - 001", "SSP", "Blood", None),
        (2, "1", "Arm B", "VISIT - 001", "SSP", "Blood", None),
        (3, "1", "Arm A", "VISIT - 001", "Arm A", "Scan", 1),
    ], "row_id long, cpms_id string, source_sheet string, visit string, study_arm string, activity string, "
       "staff_group int")
    out = {r.row_id: r.contract_cost for r in costjoin.join_ict_costs(df, cost).collect()}
    assert out == {1: Decimal("10.00"), 2: Decimal("20.00"), 3: Decimal("99.00")}
    # the five-key join of the source fans out on the SSP key
    compat = costjoin.join_ict_costs(df, cost, compat=True)
    assert compat.count() == 5
    assert costjoin.cost_dup_audit(cost).count() == 1
