from collections import Counter

from ledgerflow.sources import fixtures

NATION = ("n_nationkey long, n_name string", [(1, "N")])
SUPPLIER = ("s_suppkey long, s_name string, s_nationkey long", [(k, f"S{k}", 1) for k in range(3)])
PART = ("p_partkey long, p_name string, p_type string, p_size int",
        [(0, "a", "ECONOMY", 1), (1, "b", "LARGE", 5), (2, None, "PROMO", 7)])
PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None]
ORDERS = ("o_orderkey long, o_custkey long, o_orderpriority string",
          [(k, None if k == 17 else k % 4, PRIORITY[k % 6]) for k in range(24)])
LINES = [(k % 24, k % 3, (k + 1) % 3, 1 + k // 24, float(k % 50 + 1), 1.5 * k, 0.0 if k % 5 == 0 else 0.1,
          [0.08, 0.02, None][k % 3], ["A", "N", None][k % 3]) for k in range(120)]
LINEITEM = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string", [*LINES, LINES[7]])


def tables(spark, path):
    for name, (schema, rows) in dict(nation=NATION, supplier=SUPPLIER, part=PART, orders=ORDERS, lineitem=LINEITEM,
                                     region=("r_regionkey long", []), customer=("c_custkey long", [])).items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")


def test_the_grid_in_one_pass_has_the_rows_of_its_view(spark, tmp_path):
    tables(spark, tmp_path)
    plain = fixtures.fixture(spark, str(tmp_path), "fx_grid")
    one = fixtures.Fixtures(spark, str(tmp_path)).grid
    assert one.dtypes == plain.dtypes
    key = lambda df: Counter((r.cpms_id, r.sheet_name, r.sheet_pos, r.row_idx, tuple(r.cells)) for r in df.collect())
    assert key(one) == key(plain)
    assert one.count() > 120


def test_the_grid_deals_its_lines_once(spark, tmp_path):
    tables(spark, tmp_path)
    text, deps = fixtures.SPARK_VIEWS["fx_grid"]
    assert deps == ("fx_base",)
    fixtures.materialized(spark, str(tmp_path), "fx_base").createOrReplaceTempView("fx_base")
    plan = spark.sql(fixtures.dialect(text, "spark"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
