"""Occurrence and row numbers do not depend on how the rows are dealt into buckets."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.operators import longform
from ledgerflow.operators.keys import dense_sequence
from ledgerflow.operators.sequence import row_bucket, with_copies

SIZES = [1, 2, 7, 10, 10_000]
ROWS = "workbook_id string, sheet_name string, study_arm string, activity string, is_moved int, source_sheet_pos int, target_sheet_pos long, row_idx long, counts array<int>"


def rows(seed: int) -> list[tuple]:
    """Sheets with rows moved from other sheets, whose row numbers lie among their own."""
    r = random.Random(seed)
    out = []
    for wb in ("W1", "W2"):
        for source in (1, 2, 3):
            for row_idx in r.sample(range(1, 60), 25):
                target = r.choice([source, source, 9])
                sheet = {9: "Pharmacy"}.get(target, f"Arm {target}")
                arm = r.choice([sheet, sheet, None]) if sheet != "Arm 3" else r.choice([sheet, "UA"])
                out.append((wb, sheet, arm, r.choice(["a", "b"]), int(target != source), source, target, row_idx, [r.choice([0, 0, 1, 2, 5]) for _ in range(r.randint(0, 4))]))
    return out


def reference(data: list[tuple]) -> set[tuple]:
    """(workbook, source, row, visit, copy) with occurrence and row id, by counting one by one."""
    order = sorted(data, key=lambda r: (r[0], r[6], r[4], r[5], r[7]))
    flat = {(r[0], r[1]) for r in data if sum(r[8]) and r[2] in longform.PSEUDO_ARMS}
    out, seen, row_id = set(), {}, {}
    for wb, sheet, arm, act, _, source, _, row_idx, counts in order:
        for v, n in enumerate(counts, 1):
            for copy in range(1, n + 1):
                key = (wb, sheet, arm, act, v)
                seen[key] = seen.get(key, 0) + 1
                row_id[wb] = row_id.get(wb, 0) + 1
                one = (wb, sheet) in flat or sheet in longform.FIRST_VISIT_SHEETS
                out.add((wb, source, row_idx, v, copy, 1 if one else seen[key], row_id[wb]))
    return out


@pytest.mark.parametrize("size", SIZES)
def test_numbers_are_the_same_for_any_bucket(spark, size):
    data = rows(size)
    df = spark.createDataFrame(data, ROWS)
    starts = longform.with_row_starts(df, size)
    got = longform.occurrences(longform.with_occurrence_starts(longform.visit_rows(starts), size)) \
        .select("workbook_id", "source_sheet_pos", "row_idx", "visit_pos", "copy", "activity_occurrence_id", "row_id").collect()
    assert len(got) == sum(sum(r[8]) for r in data)
    assert {tuple(r) for r in got} == reference(data)


def test_rows_moved_into_a_sheet_come_after_its_own_whatever_their_number(spark):
    data = [("W", "Arm 1", "Arm 1", "a", m, s, 1, i, [1]) for m, s, i in ((0, 1, 5), (0, 1, 25), (1, 2, 3), (1, 2, 30))]
    df = spark.createDataFrame(data, ROWS)
    got = longform.occurrences(longform.with_occurrence_starts(longform.visit_rows(df), 10)).collect()
    assert [(r.is_moved, r.row_idx, r.activity_occurrence_id) for r in sorted(got, key=lambda r: (r.is_moved, r.row_idx))] == [(0, 5, 1), (0, 25, 2), (1, 3, 3), (1, 30, 4)]


def test_no_bucket_holds_more_rows_than_its_size(spark):
    """Visits and copies do not count: the rows are numbered before they are multiplied."""
    df = spark.range(1, 101).selectExpr("id as row_idx", "cast(1000 as int) as n", "'k' as k").withColumn("b", row_bucket("row_idx", 10))
    assert df.groupBy("b").count().agg(F.max("count")).first()[0] <= 10
    numbered = dense_sequence(df, partition_cols=["k"], order_cols=["row_idx"], bucket_col="b", out_col="start", weight_col="n")
    assert {(r.row_idx, r.start) for r in numbered.collect()} == {(i, 1000 * (i - 1)) for i in range(1, 101)}
    copies = with_copies(numbered, "n", "copy").select((F.col("start") + F.col("copy")).alias("x"))
    assert copies.agg(F.countDistinct("x"), F.min("x"), F.max("x")).first() == (100_000, 1, 100_000)


def test_weighted_numbers_equal_a_plain_window(spark):
    df = spark.range(300).selectExpr("id as r", "id % 3 as p", "cast(id * 7 % 5 as int) as w").withColumn("b", F.floor(F.col("r") / 11))
    got = dense_sequence(df, partition_cols=["p"], order_cols=["r"], bucket_col="b", out_col="s", weight_col="w").drop("b")
    before = Window.partitionBy("p").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    want = df.drop("b").withColumn("s", F.coalesce(F.sum("w").over(before), F.lit(0)))
    assert sorted(got.collect()) == sorted(want.collect())


def test_rows_of_one_bucket_are_dealt_once(spark):
    from pyspark.sql import functions as F

    from ledgerflow.operators.sequence import fill_forward, one_bucket
    df = spark.range(200).select(F.col("id").alias("r"), (F.col("id") % 3).alias("p"), F.when(F.col("id") % 17 == 0, F.col("id")).alias("v"),
                                 F.lit(2).alias("w"), F.lit(0).alias("b"))
    assert one_bucket(df, "r", 200) and not one_bucket(df, "r", 199)
    assert not one_bucket(df.unionByName(spark.createDataFrame([(None, 1, None, 1, 0)], "r long, p long, v long, w int, b int")), "r", 200)
    assert one_bucket(df.limit(0), "r")

    def exchanges(out):
        return out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    def rows(out):
        return sorted(map(str, out.collect()))

    fill = dict(partition_cols=["p"], order_col="r", value_col="v", out_col="f", bucket_size=200)
    once = fill_forward(df, **fill, single=True)
    assert exchanges(once) == 1 and rows(once) == rows(fill_forward(df, **fill))
    for weight in (None, "w"):
        number = dict(partition_cols=["p"], order_cols=["r"], bucket_col="b", out_col="s", weight_col=weight)
        once = dense_sequence(df, **number, single=True)
        assert exchanges(once) == 1 and once.dtypes == dense_sequence(df, **number).dtypes
        assert rows(once) == rows(dense_sequence(df, **number))
