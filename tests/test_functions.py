from decimal import Decimal

from pyspark.sql import functions as F

from ledgerflow.functions import nulls, text


def test_trim_strips_all_whitespace(spark):
    df = spark.createDataFrame([("\t a \n",), (None,)], "s string")
    assert [r[0] for r in df.select(nulls.trim_ws("s")).collect()] == ["a", None]


def test_membership_is_never_unknown(spark):
    df = spark.createDataFrame([("UA",), ("Arm A",), (None,)], "s string")
    rows = df.select(nulls.is_in("s", ["UA"]).alias("i"), nulls.not_in("s", ["UA"]).alias("n")).collect()
    assert [(r.i, r.n) for r in rows] == [(True, False), (False, True), (False, True)]


def test_currency_text(spark):
    # cost_text: digits and dots only survive
    df = spark.createDataFrame([("£1,234.50",), ("-5",), ("(12.50)",), ("1.2.3",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(nulls.parse_currency("s")).collect()]
    assert got == [1234.5, 5.0, 12.5, None, None, None]


def test_half_even_prices(spark):
    # price_half: 2.5 -> 2, 3.5 -> 4
    df = spark.createDataFrame([(Decimal("2.50"),), (Decimal("3.50"),)], "p decimal(18,2)")
    assert [r[0] for r in df.select(nulls.round_even("p", 0)).collect()] == [Decimal(2), Decimal(4)]


def test_key_padding_widens(spark):
    # key_overflow: 10001 keys -> EDGE-10001, never truncated
    df = spark.createDataFrame([(1,), (10001,)], "n long")
    assert [r[0] for r in df.select(text.edge_key("n")).collect()] == ["EDGE-0001", "EDGE-10001"]


def test_sheet_safe(spark):
    df = spark.createDataFrame([("a/b:c*d?e[f]g\\h" + "x" * 40,)], "s string")
    out = df.select(text.sheet_safe("s")).first()[0]
    assert out.startswith("a_b_c_d_e_f_g_h") and len(out) == 31


def test_visit_number_format(spark):
    df = spark.range(1, 3).select(text.visit_number(F.col("id")).alias("v"))
    assert [r.v for r in df.collect()] == ["VISIT - 001", "VISIT - 002"]
