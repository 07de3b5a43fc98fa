import pytest
from pyspark.sql import functions as F

from ledgerflow.sinks import files


def test_sheet_names_are_unique_against_all_others(spark):
    rows = [(1, n) for n in ("X/Y", "X:Y", "X_Y_2", "a" * 40, "a" * 33, "b")] + [(2, "X/Y")]
    df = spark.createDataFrame(rows, "s int, n string")
    out = {(r.s, r.n): r.safe_name for r in files.safe_sheet_names(df, name_col="n", scope_cols=["s"], order_cols=["n"]).collect()}
    assert len({(s, v) for (s, _), v in out.items()}) == len(rows) and all(len(v) <= 31 for v in out.values())
    assert out[1, "X_Y_2"] == "X_Y_2" and out[1, "X/Y"] == "X_Y" and out[1, "X:Y"] == "X_Y_3" and out[2, "X/Y"] == "X_Y"


def test_templates_with_colliding_names_stay_apart(spark, tmp_path):
    df = spark.createDataFrame([("1", "A", "arm", n, i) for i, n in enumerate(("X/Y", "X:Y", "X_Y_2"))], "cpms_id string, scenario_id string, template_kind string, template_name string, v int")
    files.write_templates(df, str(tmp_path / "t"), fmt="parquet")
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.select("template_sheet").distinct().count() == 3
    assert {(r.template_kind, r.template_name, r.v) for r in back.collect()} == {("arm", "X/Y", 0), ("arm", "X:Y", 1), ("arm", "X_Y_2", 2)}


def test_cost_table_by_studies_keeps_the_others_and_text_ids(spark, tmp_path):
    from ledgerflow.sources.readers import read_cost_table
    cols = "cpms_id string, visit_number string, study_arm string, ict_cost double"
    path = str(tmp_path / "c")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    files.write_cost_table(spark.createDataFrame([("007", "V", "A", 1.0), ("8", "V", "A", 2.0)], cols), path)
    files.write_cost_table(spark.createDataFrame([("8", "V", "A", 3.0)], cols), path, mode="studies")
    assert {(r.cpms_id, r.ict_cost) for r in read_cost_table(spark, path).collect()} == {("007", 1.0), ("8", 3.0)}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    with pytest.raises(ValueError, match="NOT NULL"):
        files.write_cost_table(spark.createDataFrame([(None, "V", "A", 3.0)], cols), path)
    with pytest.raises(ValueError, match="NOT NULL"):
        files.upsert_cost_table(path, spark.createDataFrame([("9", "V", "A", None)], cols), str(tmp_path / "n"))


def test_a_large_folder_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(4000).select(F.lit("1").alias("cpms_id"), F.lit("Pharmacy").alias("sheet_name"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # 4,000 rows would be put together again
    files.write_per_sheet(df, str(tmp_path / "s"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "s" / "cpms_id=1" / "safe_sheet=Pharmacy").glob("part-*"))) > 1


def test_a_stored_plan_is_exported_without_another_copy(spark, tmp_path, monkeypatch):
    from ledgerflow.sources.stage import materialize
    rows = [(str(c), r, t) for c in range(3) for r in range(50) for t in ("DIRECT", "OVERHEAD")]
    plan = materialize(spark.createDataFrame(rows[::-1], "cpms_id string, row_id long, posting_line_type_id string"), "t")
    stored = []
    monkeypatch.setattr(files, "materialize", lambda df, name: stored.append(name) or materialize(df, name))
    for name, more in (("a", {}), ("b", {"stored": True})):
        files.write_posting_csv(plan, str(tmp_path / name), **more)
        lines = [line for f in sorted((tmp_path / name).glob("part-*")) for line in f.read_text().splitlines()[1:]]
        assert lines == [",".join(map(str, r)) for r in rows]
    assert stored == ["export"]


COST = "cpms_id string, visit_number string, study_arm string, ict_cost double"


def stored_bytes(path) -> int:
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_an_upsert_writes_only_the_studies_it_touches(spark, tmp_path):
    from ledgerflow.sinks import versions
    path = tmp_path / "c"
    many = spark.range(100 * 50).selectExpr("cast(id % 100 as string) cpms_id", "concat('V', cast(id div 100 as string)) visit_number", "uuid() study_arm", "1.0D ict_cost")
    many.write.parquet(str(tmp_path / "in"))
    many = spark.read.parquet(str(tmp_path / "in"))
    files.write_cost_table(many, str(path))
    before = stored_bytes(path / "data")
    key = many.where("cpms_id = '7' and visit_number = 'V3'").first()
    out = files.upsert_cost_table(str(path), spark.createDataFrame([("7", "V3", key.study_arm, 9.0), ("new", "V1", "A", 2.0)], COST))
    assert stored_bytes(path / "data") - before < 0.05 * before
    want = {tuple(r) for r in many.collect()} - {tuple(key)} | {("7", "V3", key.study_arm, 9.0), ("new", "V1", "A", 2.0)}
    assert {tuple(r) for r in out.collect()} == want and out.count() == len(want)
    # Above the bound on names the studies are found by a join instead.
    keep, versions.NAMED = versions.NAMED, 0
    try:
        again = files.upsert_cost_table(str(path), spark.createDataFrame([("7", "V3", key.study_arm, 10.0)], COST))
    finally:
        versions.NAMED = keep
    assert {tuple(r) for r in again.collect()} == want - {("7", "V3", key.study_arm, 9.0)} | {("7", "V3", key.study_arm, 10.0)}


def test_an_upsert_with_other_types_keeps_the_table_in_one_schema(spark, tmp_path):
    path = str(tmp_path / "c")
    files.write_cost_table(spark.createDataFrame([("1", "V", "A", 1), ("2", "V", "A", 2)], "cpms_id string, visit_number string, study_arm string, ict_cost int"), path)
    out = files.upsert_cost_table(path, spark.createDataFrame([("2", "V", "A", 2.5)], COST))
    assert {(r.cpms_id, r.ict_cost) for r in out.collect()} == {("1", 1.0), ("2", 2.5)}


def test_a_failed_write_leaves_the_old_table_readable(spark, tmp_path):
    from ledgerflow.sources.readers import read_cost_table
    path = str(tmp_path / "c")
    files.write_cost_table(spark.createDataFrame([("1", "V", "A", 1.0)], COST), path)
    broken = spark.range(10).selectExpr("cast(id as string) cpms_id", "'V' visit_number", "'A' study_arm", "if(id = 9, cast(raise_error('lost') as double), 2.0D) ict_cost")
    with pytest.raises(Exception, match="lost"):
        files.write_cost_table(broken, path)
    with pytest.raises(ValueError, match="NOT NULL"):
        files.write_cost_table(spark.createDataFrame([("1", "V", None, 5.0)], COST), path, mode="studies")
    assert [tuple(r)[:1] + (r.ict_cost,) for r in read_cost_table(spark, path).collect()] == [("1", 1.0)]
    files.write_cost_table(spark.createDataFrame([("2", "V", "A", 3.0)], COST), path)
    assert [(r.cpms_id, r.ict_cost) for r in read_cost_table(spark, path).collect()] == [("2", 3.0)]
    files.write_cost_table(spark.createDataFrame([], COST), path)
    assert read_cost_table(spark, path).count() == 0


def test_exports_are_in_order_over_the_files_of_a_folder(spark, tmp_path):
    import csv
    df = spark.range(3000).selectExpr("if(id % 3 = 0, '1', '2') cpms_id", "'A' scenario_id", "'Arm / 1' sheet_name", "(id * 7919) % 3000 row_id", "'T' posting_line_type_id").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    files.write_posting_per_sheet(df, str(tmp_path / "p"), date="2024-01-02")
    files.write_posting_csv(df, str(tmp_path / "q"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    folder = tmp_path / "p" / "export_date=2024-01-02" / "cpms_id=2" / "scenario_id=A" / "safe_sheet=Arm _ 1"
    read = lambda names: [r for f in sorted(names) for r in csv.DictReader(f.open())]
    rows = [int(r["row_id"]) for r in read(folder.glob("part-*"))]
    assert rows == sorted(rows) and len(rows) == 2000 and len(list(folder.glob("part-*"))) > 1
    plan = [(r["cpms_id"], int(r["row_id"])) for r in read((tmp_path / "q").glob("part-*"))]
    assert plan == sorted(plan) and len(plan) == 3000


def test_strict_checks_run_in_the_job_that_reads(spark):
    from ledgerflow.operators.rules import apply_amount_map, apply_routing
    lines = spark.createDataFrame([("T", 1.0, "A", "k"), ("U", 2.0, "A", "k")], "posting_line_type_id string, activity_cost_num double, scenario_id string, medic_key string")
    once = lines.withColumn("activity_cost_num", F.when(F.col("activity_cost_num") > 5, F.raise_error(F.lit("read"))).otherwise(F.col("activity_cost_num")))
    amap = spark.createDataFrame([("T", 1.0, 1.0)], "posting_line_type_id string, base_mult double, split_mult double")
    priced = apply_amount_map(once, amap, strict=True)
    with pytest.raises(Exception, match="missing amount_map for .*U"):
        priced.collect()
    assert priced.where("posting_line_type_id = 'T'").count() == 1
    unread = apply_amount_map(lines.withColumn("activity_cost_num", F.raise_error(F.lit("read")).cast("double")), amap, strict=True)
    assert "posting_amount" in unread.columns  # nothing has been run
    rules = "ruleset_id string, scenario_id string, condition_field string, condition_op string, condition_value string, posting_line_type_id string, destination_bucket string, priority int"
    routes = spark.createDataFrame([("R", "A", None, None, None, "T", "B", 1)], rules)
    routed = apply_routing(lines, routes, ruleset_id="R", strict=True)
    with pytest.raises(Exception, match="missing routing for posting line: A, "):
        routed.collect()


def test_grids_are_read_with_their_rejects(spark, tmp_path):
    from ledgerflow.sources.readers import read_grids
    good = '{"workbook_id":"W","sheet_name":"S","sheet_pos":1,"row_idx":1,"cells":["a",null]}'
    (tmp_path / "g.json").write_text("\n".join([good, good[:40], '{"workbook_id":"W","sheet_name":"S"}', '{"sheet_name":"S","row_idx":3}', "[]x", '{"workbook_id":"W","sheet_name":"S","row_idx":"many"}']))
    rows, rejected = read_grids(spark, str(tmp_path / "g.json"), "json")
    assert [tuple(r) for r in rows.collect()] == [("W", "S", 1, 1, ["a", None])]
    bad = {r.record: r for r in rejected.collect()}
    assert len(bad) == 5 and "[]x" in bad
    assert {r.reason for x, r in bad.items() if x in (good[:40], '{"workbook_id":"W","sheet_name":"S","row_idx":"many"}')} == {"unreadable record"}
    assert bad[good[:40]].workbook_id is None and {r.reason for r in bad.values()} >= {"no row number", "no workbook"}
    rows.write.parquet(str(tmp_path / "p"))
    again, none = read_grids(spark, str(tmp_path / "p"))
    assert again.count() == 1 and none.count() == 0


def test_rules_are_filtered_in_the_scan(spark, tmp_path):
    from ledgerflow.sources.fixtures import Fixtures
    from ledgerflow.sources.readers import load_rules
    from tests.conftest import SF_SMALL
    fx = Fixtures(spark, SF_SMALL)
    for name in ("dist_rules", "amount_map", "routing_rules"):
        getattr(fx, name).write.parquet(f"{tmp_path}/{name}")
    rules = load_rules(spark, str(tmp_path), "COMM_AH_V1")
    for df in (rules.dist_rules, rules.routing_rules):
        assert "EqualTo(ruleset_id,COMM_AH_V1)" in df._jdf.queryExecution().executedPlan().toString()


def test_a_cluster_without_a_shared_folder_fails(spark, monkeypatch):
    from ledgerflow import session

    class Unset:
        master = "spark://somewhere"

        def getConf(self):
            return {}

        @property
        def _jsc(self):
            return self

        def sc(self):
            return self

        def getCheckpointDir(self):
            return self

        def isDefined(self):
            return False

    class Session:
        sparkContext = Unset()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_strict_pricing_fails_on_repeated_line_types(spark):
    from ledgerflow.operators.rules import apply_amount_map
    plan = spark.createDataFrame([("T", 1.0)], "posting_line_type_id string, activity_cost_num double")
    amap = spark.createDataFrame([("T", 1.0, 1.0), ("T", 2.0, 1.0)], "posting_line_type_id string, base_mult double, split_mult double")
    with pytest.raises(ValueError, match="more than once"):
        apply_amount_map(plan, amap, strict=True)


def test_compat_costs_keep_repeated_keys(spark):
    from ledgerflow.operators.costjoin import visit_costs
    cost = spark.createDataFrame([("1", "V", "A", None, 1.0), ("1", "V", "A", None, 2.0)], "cpms_id string, visit_number string, study_arm string, activity_name string, ict_cost double")
    assert visit_costs(cost).count() == 1 and visit_costs(cost, compat=True).count() == 2


def test_the_whole_run_fails_without_templates(spark):
    from ledgerflow.plans import pipeline
    plan = spark.createDataFrame([], "cpms_id string, scenario_id string, row_id long, sheet_name string, study_name string, study_arm string, activity string, visit string, visit_label string, staff_group int, posting_line_type_id string, posting_amount decimal(18,6), contract_cost double")
    assert pipeline.build_templates(plan).count() == 0
    with pytest.raises(ValueError, match="no template"):
        pipeline.build_templates(plan, fail_if_empty=True)


def test_files_of_the_cost_table_do_not_grow_with_its_studies(spark, tmp_path):
    path = tmp_path / "c"
    rows = spark.range(3000).selectExpr("if(id = 7, null, cast(id as string)) cpms_id", "'V' visit_number", "'A' study_arm", "cast(id as double) ict_cost")
    files.write_cost_table(rows, str(path), strict=False)
    files.write_cost_table(rows.where("ict_cost % 2 = 0 or ict_cost = 7"), str(path), mode="studies", strict=False)
    assert len(list((path / "data").rglob("part-*.parquet"))) < 300
    from ledgerflow.sources.readers import read_cost_table
    assert sorted(map(str, read_cost_table(spark, str(path)).select(rows.columns).collect())) == sorted(map(str, rows.collect()))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_many_small_folders_are_written_by_several_tasks_without_side_files(spark, tmp_path, monkeypatch, fmt):
    monkeypatch.setattr(files, "FOLDERS_PER_TASK", 10)
    df = spark.range(300).selectExpr("cast(id % 25 as string) cpms_id", "'A' scenario_id", "if(id % 2 = 0, null, 'Arm') sheet_name", "id row_id", "'T' posting_line_type_id")
    path = tmp_path / "p"
    files.write_posting_per_sheet(df, str(path), date="2024-01-02", fmt=fmt)
    parts = list(path.rglob("part-*"))
    assert len({f.name[:10] for f in parts}) > 4  # else the few bytes are one task's
    assert not list(path.rglob("*.crc"))
    assert len({f.parent for f in parts}) == 50
    back = spark.read.option("header", True).format(fmt).load(str(path))
    assert sorted(int(r.row_id) for r in back.collect()) == list(range(300))
