"""Tables in buckets of a key, and the workbook steps that deal no row again."""

import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.operators import costs, grid, longform
from ledgerflow.operators.sequence import dense_sequence, small_groups
from ledgerflow.sources.stage import materialize_dealt


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def raw(spark):
    head = ["Activity", "Activity Type", "Department", "Staff Role", "Activity Cost", "Day 1", "Day 2", "Total Activity Cost"]
    out = []
    for w in ("w1", "w2", "w3"):
        for pos, sheet in enumerate(["Arm A", "Arm B", "Setup & Closedown"], 1):
            rows = [["Study", f"S {w}"], ["Study Id", w], head]
            for i in range(6):
                rows.append([f"act {i % 2}", "Procedure", "Pharmacy" if i == 4 else "Research", "Nurse", "5", str(i % 3), "1", "12.5"])
                rows += [["Scheduled / Some Participants", *[None] * 7]] if i == 2 else []
            rows.append([None, None, None, None, "Total Including MFF", "10", "20", None])
            out += [(w, sheet, pos, n, cells) for n, cells in enumerate(rows, 1)]
    return spark.createDataFrame(out, "workbook_id string, sheet_name string, sheet_pos long, row_idx long, cells array<string>").repartition(5)


def test_a_dealt_table_is_not_dealt_again(spark, raw):
    dealt = materialize_dealt(raw.repartition(8, "workbook_id"), "t", "workbook_id", 8)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, raw.collect()))
    w = Window.partitionBy("workbook_id", "sheet_name")
    assert exchanges(raw.select("workbook_id", F.max("row_idx").over(w))) == 1
    assert exchanges(dealt.select("workbook_id", F.max("row_idx").over(w))) == 0
    layout = grid.stored_layout(dealt)
    assert grid.small_workbooks(dealt, layout)
    flagged = grid.with_flags(grid.sheet_table(dealt, layout, by_workbook=True), single=True)
    assert exchanges(grid.with_staff_group(grid.clean_rows(flagged), single=True)) == 1  # the layout's


@pytest.mark.parametrize("bucket", [2, 1_000_000])
def test_workbook_steps_give_the_same_rows_however_they_are_dealt(spark, raw, bucket):
    dealt = materialize_dealt(raw.repartition(8, "workbook_id"), "t", "workbook_id", 8)
    layout, table, clean = grid.stage_a(dealt, bucket_size=bucket)
    layout2, table2, clean2 = grid.stage_a(raw, bucket_size=3)

    def rows(df):
        return sorted(str(sorted(r.asDict().items())) for r in df.collect())

    assert rows(table) == rows(table2) and rows(clean) == rows(clean2) and clean.count() == 54
    a, b = (longform.stage_b(c, t, lay, bucket_size=k) for c, t, lay, k in ((clean, table, layout, bucket), (clean2, table2, layout2, 3)))
    assert rows(a) == rows(b) and a.count() > 54
    assert rows(costs.cost_table(table, layout, clean, bucket)) == rows(costs.cost_table(table2, layout2, clean2, 3))


def test_split_cost_rows_deal_no_row_and_broadcast_no_sheet(spark, raw, monkeypatch):
    dealt = materialize_dealt(raw.repartition(8, "workbook_id"), "t", "workbook_id", 8)
    layout, table, clean = grid.stage_a(dealt)
    labels = costs.label_lookup(table, layout)
    for df in (labels, costs.summary_costs(table, layout)):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    split, whole = (costs.expand_cost_rows(clean, labels, k) for k in (2, 1_000_000))
    assert exchanges(split) == 0 and split.count() == whole.count() == 72
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    # Workbooks with more rows than one task should hold are dealt by sheet and bucket.
    monkeypatch.setattr(costs, "DEFAULT_BUCKET", 5)
    large = costs.expand_cost_rows(clean, labels, 2)
    assert exchanges(large) > 0 and sorted(map(str, large.collect())) == sorted(map(str, whole.collect()))


def test_split_row_and_occurrence_ids_deal_no_row(spark, raw, monkeypatch):
    dealt = materialize_dealt(raw.repartition(8, "workbook_id"), "t", "workbook_id", 8)
    layout, table, clean = grid.stage_a(dealt)

    def rows(df):
        return sorted(str(sorted(r.asDict().items())) for r in df.collect())

    split, whole = (longform.stage_b(clean, table, layout, bucket_size=k) for k in (2, 1_000_000))
    assert exchanges(split) == 0
    assert rows(split) == rows(whole) and split.count() > 54
    routed = longform.reroute(clean.withColumnRenamed("sheet_pos", "source_sheet_pos"), longform.workbook_has_ua(table))
    visits = longform.visit_rows(longform.by_target_sheet(longform.with_visit_counts(routed)))
    ids = [longform.numbered_occurrences(visits, k, *longform.numbered_whole(clean, k)) for k in (2, 1_000_000)]
    assert exchanges(ids[0]) == 0 and rows(ids[0]) == rows(ids[1])
    # Workbooks with more rows than one task should hold are dealt by bucket.
    monkeypatch.setattr(longform, "DEFAULT_BUCKET", 5)
    assert longform.numbered_whole(clean, 2) == (False, False)
    large = longform.stage_b(clean, table, layout, bucket_size=2)
    assert exchanges(large) > 0 and rows(large) == rows(whole)


def test_numbering_by_buckets_deals_the_rows_once(spark):
    df = spark.createDataFrame([(k, r, r // 3) for k in ("a", None) for r in range(10)], "k string, r long, b long")
    more = spark.createDataFrame([("a", 1), (None, 2)], "k string, fact int")
    got = dense_sequence(df, partition_cols=["k"], order_cols=["r"], bucket_col="b", out_col="s", facts=(more, ["k"]))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(k, r, r // 3, 1 if k else 2, r + 1) for k in ("a", None) for r in range(10)], key=str)
    plain = dense_sequence(df, partition_cols=["k"], order_cols=["r"], bucket_col="b", out_col="s")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(plain) == 4  # rows, counts, offsets by k and back
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_target_sheet_position_of_names_that_differ_in_blanks(spark):
    sheets = spark.createDataFrame([("w", "Arm A", 1), ("w", " Arm A", 2), ("w", "Arm B", 3)], "workbook_id string, sheet_name string, sheet_pos long")
    rows = spark.createDataFrame([("w", "Arm A", 2, 0), ("w", "Arm B", 3, 0), ("w", "Pharmacy", 3, 1), ("w", "Unscheduled Activities", 1, 1)],
                                 "workbook_id string, sheet_name string, source_sheet_pos long, is_moved int")
    got = longform.with_target_sheet_pos(rows, sheets).select("sheet_name", "target_sheet_pos").collect()
    assert sorted(map(tuple, got)) == [("Arm A", 1), ("Arm B", 3), ("Pharmacy", 5), ("Unscheduled Activities", 4)]


def test_small_groups(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert small_groups(df, "k", 2) and not small_groups(df, "k", 1) and small_groups(df.limit(0), "k", 1)


def test_lines_dealt_by_study_are_the_rows_of_the_view(spark, tmp_path):
    from ledgerflow.sources import fixtures
    assert set(fixtures.SPARK_VIEWS) == {"fx_grid", "fx_long"}
    lines = [(1, 2, 3, 4, 7.0, 10.5, 0.0, 0.01, "A", c, f"Study {c}" if c else None, s, "p", "PROMO", 5, "s", "n")
             for c in ("8", "9", None) for s in ("Arm A", "Pharmacy")]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_tax double, l_returnflag string, cpms_id string, study_name string, sheet_name string, p_name string, p_type string, p_size int, "
                          "s_name string, n_name string").createOrReplaceTempView("fx_base")
    text, _ = fixtures.SPARK_VIEWS["fx_long"]
    # Lines that tie in all of the order may be numbered either way.
    got, want = ([sorted(str(r[:3] + r[4:]) for r in df.collect()) for df in (spark.sql(fixtures.dialect(t, "spark")) for t in (text, fixtures.FX_LONG))])
    assert got == want and len(got) == 6


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(c, f"Study {c}", s, r, a, s, f"act {r % 3}" if r % 4 else None, f"VISIT - 00{r % 2}", f"Day.{r % 2}", r % 2, t, role, "£10.5")
            for c in ("8", "9", "10", None)
            for r, (s, a, t, role) in enumerate([("Arm A", "Arm A", "Procedure", "Nurse"), ("Arm A", "SSP", "lab investigation", "Medical Staff"),
                                                 ("Pharmacy", "Arm A", "Procedure", None), ("Setup & Closedown", "SC", "Procedure", " Medical Staff"),
                                                 ("Unscheduled Activities", "UA", "Procedure", "Nurse"), (None, None, "Procedure", "Medical Staff")] * 2, 1)]
    long = spark.createDataFrame(rows, "cpms_id string, study_name string, sheet_name string, row_id long, study_arm string, source_sheet string, activity string, "
                                       "visit string, visit_label string, staff_group int, activity_type string, staff_role string, activity_cost string")
    cost = long.select("cpms_id", F.col("study_name").alias("study"), F.col("visit").alias("visit_number"), "study_arm", "visit_label",
                       F.when(F.col("row_id") % 3 > 0, F.col("activity")).alias("activity_name"), (F.col("row_id") * 7).cast("decimal(18,2)").alias("ict_cost"),
                       F.lit(1).alias("activity_occurrence_id"), "staff_group", "source_sheet")
    return long, cost


def test_plan_keys_and_templates_by_study_are_those_of_any_deal(spark, lines, monkeypatch):
    from ledgerflow.operators.keys import assign_edge_keys
    from ledgerflow.plans import pipeline
    from ledgerflow.plans.queries_posting import rule_tables
    from ledgerflow.sources import stage
    from ledgerflow.sources.fixtures import Fixtures
    rules = rule_tables(Fixtures(spark, "", materialize=False))
    long, cost = lines
    dealt = [materialize_dealt(df.repartition(8, "cpms_id"), "t", "cpms_id", 8) for df in lines]

    def rows(df):
        return sorted(str(sorted(r.asDict().items())) for r in df.collect())

    plain = pipeline.stored_adjusted_plan(long, rules, cost, scenario_id="A", strict=False)
    by_study = pipeline.stored_adjusted_plan(dealt[0], rules, dealt[1], scenario_id="A", strict=False)
    assert "dealt" in by_study.schema["cpms_id"].metadata and "dealt" not in plain.schema["cpms_id"].metadata
    assert rows(plain) == rows(by_study) and by_study.filter("cpms_id IS NULL").count() > 0
    assert rows(pipeline.stored_keys(plain)) == rows(pipeline.stored_keys(by_study))
    assert rows(pipeline.stored_templates(plain)) == rows(pipeline.stored_templates(by_study))
    keyed = pipeline.by_study(by_study, [pipeline.stored_keys(by_study)], "t", lambda a, keys, known=(): assign_edge_keys(a, keys=keys, known=known))
    assert rows(keyed) == rows(assign_edge_keys(plain))
    # A study with more lines than one task should hold takes the form that splits.
    monkeypatch.setattr(pipeline, "LINES_PER_STUDY", 3)
    large = pipeline.stored_adjusted_plan(dealt[0], rules, dealt[1], scenario_id="A", strict=False)
    assert "dealt" not in large.schema["cpms_id"].metadata and rows(large) == rows(plain)
    assert rows(pipeline.stored_templates(large)) == rows(pipeline.stored_templates(plain))
    assert stage.by_dealt_key([long], "t", "cpms_id", lambda df, known: df, 100) is None


def test_plans_and_allocations_by_study_deal_no_line(spark, lines, monkeypatch):
    from ledgerflow.operators.allocate import adjust_posting_lines
    from ledgerflow.plans import pipeline, queries_posting, queries_templates
    from ledgerflow.plans.queries_posting import rule_tables
    from ledgerflow.sources.fixtures import Fixtures
    rules = rule_tables(Fixtures(spark, "", materialize=False))

    class Stored:
        def __init__(self, dealt=True):
            self.long, self.cost = [materialize_dealt(df.repartition(8, "cpms_id"), "t", "cpms_id", 8) if dealt else df for df in lines]
            self.dist_rules, self.amount_map, self.routing_rules = rules.dist_rules, rules.amount_map, rules.routing_rules

    def rows(df):
        return sorted(str(sorted(r.asDict().items())) for r in df.collect())

    def results():
        yield queries_posting.q_posting_plan(spark, "")
        yield queries_posting.q_alloc_row_grain(spark, "")
        yield queries_posting.q_mixed_price_audit(spark, "")
        yield queries_templates.q_alloc_dispatch(spark, "")
        yield queries_templates.q_alloc_dispatch_agg(spark, "")

    def use(fx):
        for module in (queries_posting, queries_templates):
            monkeypatch.setattr(module, "Fixtures", lambda *_: fx)
        return [(exchanges(df), rows(df)) for df in results()]

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, dealt = use(Stored(dealt=False)), use(Stored())
        assert [r for _, r in plain] == [r for _, r in dealt] and all(r for _, r in plain)
        assert all(n > 0 for n, _ in plain) and all(n == 0 for n, _ in dealt)
        # Groups above the bound of the splitting form, in buckets by study.
        plan = pipeline.plan_by_study(Stored().long.filter("cpms_id IS NOT NULL"), rules, Stored().cost, "t", strict=False)
        split, whole = (adjust_posting_lines(plan, method=m, rows_per_task=3, dealt_by=by) for m, by in (("agg", "cpms_id"), ("window", None)))
        assert rows(split) == rows(whole)
        # A study with more lines than one task should hold.
        monkeypatch.setattr(pipeline, "LINES_PER_STUDY", 3)
        large = use(Stored())
        assert [r for _, r in large] == [r for _, r in plain] and large[0][0] > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_shuffle_files_go_with_the_write_of_a_stage(spark):
    from ledgerflow.sources.stage import materialize

    def kept():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name)
    for store in (lambda df: materialize(df, "t"), lambda df: materialize_dealt(df, "t", "id", 8)):
        before = kept()
        stored = store(spark.range(1000).repartition(8, "id"))
        until = time.time() + 20
        while kept() - before and time.time() < until:
            time.sleep(0.2)
        assert not kept() - before and stored.count() == 1000
    assert spark.conf.get(name) == setting


def test_costs_meet_lines_that_are_dealt_by_study_where_they_are(spark, lines):
    from ledgerflow.operators.costjoin import join_ict_costs
    from ledgerflow.sources.stage import joins_by_part_of_keys
    long, cost = [materialize_dealt(df.repartition(8, "cpms_id"), "t", "cpms_id", 8).filter("cpms_id IS NOT NULL") for df in lines]
    name, before = "spark.sql.requireAllClusterKeysForCoPartition", spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(join_ict_costs(long, cost)) > 0
        with joins_by_part_of_keys(spark):
            assert exchanges(join_ict_costs(long, cost, known=("cpms_id",))) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert spark.conf.get(name) == before
