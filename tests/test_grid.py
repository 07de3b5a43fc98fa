from pyspark.sql import functions as F

from ledgerflow.functions.nulls import is_in
from ledgerflow.operators import grid, longform
from ledgerflow.operators.keys import SPECIAL_SHEETS, dense_sequence
from ledgerflow.operators.sequence import fill_forward

GRID = "workbook_id string, sheet_name string, sheet_pos int, row_idx long, cells array<string>"
HEADER = ["Activity", "Activity Type", "Department", "Staff Role", "Activity Cost", "Screening", "Day 30",
          "Day 30", "1st review", "Total Activity Cost"]


def sheet(name, pos, body, wb="W"):
    rows = [(wb, name, pos, 1, [" Study ", "S1"]), (wb, name, pos, 2, ["Study Id", " 42 "]),
            (wb, name, pos, 3, HEADER)]
    rows += [(wb, name, pos, 4 + i, cells) for i, cells in enumerate(body)]
    return rows


def test_header_names_follow_make_names(spark):
    g = spark.createDataFrame(sheet("Arm A", 1, []), GRID)
    names = [r.name for r in grid.header_names(grid.first_headers(g)).orderBy("col_pos").collect()]
    assert names == ["Activity", "Activity.Type", "Department", "Staff.Role", "Activity.Cost", "Screening",
                     "Day.30", "Day.30.1", "X1st.review", "Total.Activity.Cost"]
    meta = grid.sheet_metadata(g).first()
    assert (meta.study_name, meta.cpms_id) == ("S1", "42")


def test_fill_forward_default_then_markers(spark):
    body = [["Blood", "t", "Research", "Nurse", "£1", "1", None, None, None, "3"],
            ["Scheduled / Some Participants"] + [None] * 9,
            ["Scan", "t", "Research", "Nurse", "£1", "N/A", "2", None, None, "3"]]
    g = spark.createDataFrame(sheet("Arm A", 1, body), GRID)
    layout, table, clean = grid.stage_a(g)
    flags = {r.activity: r.flag for r in clean.collect()}
    assert flags == {"Blood": grid.FLAG_ALL, "Scan": grid.FLAG_SOME}


def test_ua_and_pharmacy_goes_to_ua_sheet(spark):
    body = [["Unscheduled / Itemised Activities"] + [None] * 9,
            ["Dose", "t", "Pharmacy", "Nurse", "£1", "1", None, None, None, "3"]]
    g = spark.createDataFrame(sheet("Arm A", 1, body), GRID)
    layout, table, clean = grid.stage_a(g)
    long = longform.stage_b(clean, table, layout)
    r = long.first()
    assert (r.sheet_name, r.study_arm, r.visit, r.activity_occurrence_id) == \
        ("Unscheduled Activities", "UA", "VISIT - 001", 1)


def test_null_sheet_kept_by_not_special(spark):
    df = spark.createDataFrame([(None,), ("Pharmacy",), ("Arm A",)], "sheet_name string")
    assert df.filter(~is_in("sheet_name", SPECIAL_SHEETS)).count() == 2


def test_bucketed_primitives_match_plain_windows(spark):
    from pyspark.sql import Window
    df = spark.range(0, 200).select(F.col("id").alias("r"), (F.col("id") % 3).alias("p"),
                                    F.when(F.col("id") % 17 == 0, F.col("id")).alias("v"))
    ff = fill_forward(df, partition_cols=["p"], order_col="r", value_col="v", out_col="f", bucket_size=7)
    w = Window.partitionBy("p").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("f", F.last("v", ignorenulls=True).over(w))
    assert sorted(ff.collect()) == sorted(ref.collect())
    seq = dense_sequence(df.withColumn("b", F.floor(F.col("r") / 7)), partition_cols=["p"], order_cols=["r"],
                         bucket_col="b", out_col="n").drop("b")
    ref2 = df.withColumn("n", F.row_number().over(Window.partitionBy("p").orderBy("r")).cast("long"))
    assert sorted(seq.collect()) == sorted(ref2.collect())


def test_names_avoid_those_that_are_taken(spark):
    df = spark.createDataFrame([(["a", "a", "a.1"],), (["a", "a", "a"],), (["a.1", "a", "a", "a.1"],), ([],)], "b array<string>")
    got = [r.n for r in df.select(grid.unique_names(F.col("b")).alias("n")).collect()]
    assert got == [["a", "a.2", "a.1"], ["a", "a.1", "a.2"], ["a.1", "a", "a.2", "a.1.1"], []]


def test_bad_sheets_are_reported_and_fail_strict_runs(spark):
    import pytest
    good, bad = sheet("Arm A", 1, [["x", "t", "d", "r", "1", "1", "1", "1", "1", "4"]]), sheet("Arm B", 2, [])
    bad[2] = ("W", "Arm B", 2, 3, ["Activity", "Activity Type", "Department", "Staff Role", "Activity cost", "V", "Total Activity Cost"])
    g = spark.createDataFrame(good + bad + [("W", "Notes", 3, 1, ["free text"])], GRID)
    assert {(r.sheet_name, r.reason) for r in grid.rejected_sheets(g).collect()} == {("Arm B", "missing column Activity.Cost"), ("Notes", "no header row")}
    with pytest.raises(ValueError, match="Arm B"):
        grid.stage_a(g)
    _, table, _ = grid.stage_a(g, strict=False)
    assert {r.sheet_name for r in table.collect()} == {"Arm A"}


def test_copies_in_blocks(spark):
    from ledgerflow.operators.sequence import with_copies
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 6), ("d", 13)], "k string, n int")
    got = sorted((r.k, r.c) for r in with_copies(df, "n", "c", block=3).collect())
    assert got == [(k, i) for k, n in (("a", 1), ("b", 7), ("c", 6), ("d", 13)) for i in range(1, n + 1)]

def test_filters_on_the_layout_work_names_out_once(spark):
    g = spark.createDataFrame([("w", "s", 1, 1, ["Activity", "Activity Type", "Department", "Staff Role", "Activity Cost", "V", "V", "Total Activity Cost"]),
                               ("w", "s", 1, 2, ["a", "t", "d", "r", "1", "1", "1", "2"])],
                              "workbook_id string, sheet_name string, sheet_pos long, row_idx long, cells array<string>")
    layout = grid.sheet_layout(g)
    valid = layout.filter(F.col("layout_error").isNull() & (F.col("n_visits") > 1))
    assert valid._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
    assert [r.visit_names for r in valid.collect()] == [["V", "V.1"]]


def test_sheets_of_one_bucket_are_dealt_once(spark):
    body = [[f"a{i % 3}" if i % 5 else grid.FLAG_MARKERS[i % 3], "t", "d", "r", "1", "1", "1", "1", "1", "2"] for i in range(40)]
    g = spark.createDataFrame(sheet("Arm A", 1, body) + sheet("Arm B", 2, body), GRID)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        clean = grid.cleaned(g)
        plan = clean._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert plan.count("Exchange hashpartitioning") == 2  # of the grid and of its layout
    rows = lambda df: sorted(map(str, df.select(clean.columns).collect()))
    assert clean.count() == 64 and rows(clean) == rows(grid.cleaned(g, bucket_size=7))
    assert rows(clean) == rows(grid.stage_a(g)[2]) == rows(grid.stage_a(g, bucket_size=7)[2])
    assert set(grid.stage_a(g)[1].columns) == set(grid.stage_a(g, bucket_size=7)[1].columns)
