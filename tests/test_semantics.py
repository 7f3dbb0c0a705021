"""Hand-computed checks of the dialect rules on literal frames."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions import semantics as s


def one(spark, expr, schema="x string", rows=None):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_ci_eq_ignores_case_and_trailing_blanks(spark):
    out = one(spark, s.ci_eq("x", "spc"), rows=[("SPC",), ("spc ",), (" spc",), (None,)])
    assert out == [True, True, False, None]


def test_ci_ne_drops_null(spark):
    df = spark.createDataFrame([("NOTREQ",), ("notreq ",), ("DONE",), (None,)], "x string")
    assert [r.x for r in df.where(s.ci_ne("x", "NOTREQ")).collect()] == ["DONE"]


def test_blank_equality(spark):
    # '' , '   ' and NULL against "= ''"
    out = one(spark, F.rtrim(F.col("x")) == "", rows=[("",), ("   ",), (None,)])
    assert out == [True, True, None]
    assert one(spark, s.is_blank("x"), rows=[("",), ("   ",), (None,), ("a",)]) == [True, True, True, False]


def test_not_like_excludes_null(spark):
    df = spark.createDataFrame([("F1",), ("f",), ("P",), (None,)], "x string")
    fee = df.where(s.ci_starts("x", "F")).count()
    service = df.where(s.ci_not_starts("x", "F")).count()
    assert (fee, service, df.count()) == (2, 1, 4)


def test_isnull_typed_keeps_type(spark):
    df = spark.createDataFrame([(None,), (Decimal("5.00"),)], "p decimal(5,2)")
    out = df.select(s.isnull_typed("p", 0, s.PERCENT).alias("v"))
    assert out.schema["v"].dataType.simpleString() == "decimal(5,2)"
    assert [r.v for r in out.collect()] == [Decimal("0.00"), Decimal("5.00")]


def test_int_key_to_date_and_parts(spark):
    df = spark.createDataFrame([(20160405,)], "k int")
    r = df.select(s.int_key_to_date("k").alias("d"), s.key_month("k").alias("m"),
                  s.key_year("k").alias("y")).first()
    assert (r.d, r.m, r.y) == (dt.date(2016, 4, 5), "04", "2016")


def test_day_boundary_difference(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 4, 25, 23, 59, 59), dt.date(2019, 4, 26))],
                               "a timestamp_ntz, b date")
    assert df.select(s.days_between("a", "b")).first()[0] == 1


def test_band_label_null_and_relabel(spark):
    df = spark.createDataFrame([(731, 1095), (0, 365), (None, 5)], "lo int, hi int")
    lab = df.select(s.band_label("lo", "hi").alias("l")).select("l", s.relabel_band("l").alias("p"))
    assert [tuple(r) for r in lab.collect()] == [
        ("731 - 1095", "731 - 1,095"), ("0 - 365", "0 - 365"), (None, None)]


def test_tier_edges(spark):
    ages = [-1, 0, 1, 365, 366, 730, 731, 1095, 1096, None]
    df = spark.createDataFrame([(a,) for a in ages], "a int")
    out = [r[0] for r in df.select(s.tier_rate("a", F.lit("Y1"), F.lit("Y2"), F.lit("Y3"),
                                                F.lit("P"))).collect()]
    assert out == ["P", "P", "Y1", "Y1", "Y2", "Y2", "Y3", "Y3", "P", "P"]


def test_percent_text(spark):
    df = spark.createDataFrame([(Decimal("7.5"),), (Decimal("10"),)], "p decimal(4,2)")
    assert [r[0] for r in df.select(s.percent_text("p")).collect()] == ["7.50", "10.00"]


def test_pay_amount_rounds_half_away_from_zero(spark):
    # 0.5 x 1.00% = 0.005 -> 0.01 ; -0.5 -> -0.01 ; 123.4567 x 10% = 12.34567 -> 12.35
    df = spark.createDataFrame([(Decimal("0.5"), Decimal("1.00")), (Decimal("-0.5"), Decimal("1.00")),
                                (Decimal("123.4567"), Decimal("10.00"))],
                               "b decimal(24,4), r decimal(5,2)")
    out = [r[0] for r in df.select(s.pay_amount(F.col("b"), F.col("r"))).collect()]
    assert out == [Decimal("0.01"), Decimal("-0.01"), Decimal("12.35")]


def test_first_of_month_and_key(spark):
    df = spark.createDataFrame([("2016", "4"), ("2016", "04")], "y string, m string")
    out = [r[0] for r in df.select(s.date_to_key(s.first_of_month("y", "m"))).collect()]
    assert out == [20160401, 20160401]
