"""Join operators: fast form equals the naive (theta / OR / correlated) form."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.aggregates import conditional_sums
from ledgerline.operators.joins import (
    anti_on, any_code_join, check_single, first_by_order, range_join, single_value_lookup,
)


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_range_join_equals_between(spark):
    rnd = random.Random(7)
    vals = [(i, rnd.choice([None, -5, 0, 1, 365, 366, 730, 9999, 10000, 12000, 12001,
                             rnd.randint(-100, 13000)])) for i in range(2000)]
    facts = spark.createDataFrame(vals, "id int, age int")
    bands = spark.createDataFrame(
        [(1, 0, 365), (2, 366, 730), (3, 731, 1095), (4, 0, 30), (5, 10000, 12000),
         (6, None, 5), (7, 20, 10)], "k int, lo int, hi int")
    fast = range_join(facts, bands, "age", "lo", "hi").select("id", "k")
    facts.createOrReplaceTempView("f")
    bands.createOrReplaceTempView("b")
    naive = spark.sql("select id, k from f join b on f.age between b.lo and b.hi")
    assert fast.count() == naive.count()
    assert same_rows(fast, naive)
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_join_wide_ranges_stay_bounded(spark):
    facts = spark.createDataFrame([(i, i * 1_000_003) for i in range(500)], "id int, v bigint")
    bands = spark.createDataFrame([(1, 0, 10**9), (2, 5 * 10**8, 2 * 10**9)], "k int, lo bigint, hi bigint")
    fast = range_join(facts, bands, "v", "lo", "hi").select("id", "k")
    facts.createOrReplaceTempView("f2")
    bands.createOrReplaceTempView("b2")
    naive = spark.sql("select id, k from f2 join b2 on f2.v between b2.lo and b2.hi")
    assert same_rows(fast, naive)


def test_a_catch_all_range_does_not_widen_narrow_ones(spark):
    """100,000 narrow ranges and one that covers everything: every range is
    exploded into a few buckets of its own level, and no bucket holds more
    than the ranges that start near it."""
    n = 100_000
    ranges = spark.range(n).selectExpr("cast(id as int) as k", "id * 7 as lo", "id * 7 + 9 as hi").union(
        spark.sql("select -1, cast(-1000000000 as bigint), cast(1000000000 as bigint)"))
    facts = spark.range(500).selectExpr("id", "(id * 9973) % 700000 as v")
    fast = range_join(facts, ranges, "v", "lo", "hi").select("id", "k")
    got = {}
    for r in fast.collect():
        got.setdefault(r.id, set()).add(r.k)
    for i in range(500):
        v = i * 9973 % 700000
        assert got[i] == {-1} | {k for k in range(max(0, (v - 9) // 7), v // 7 + 1) if 7 * k <= v <= 7 * k + 9 and k < n}
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_range_join_extremes(spark):
    big = 2**62
    facts = spark.createDataFrame([(1, -big), (2, big), (3, 0), (4, None), (5, -1)], "id int, v bigint")
    ranges = spark.createDataFrame([(1, -big, big), (2, big, big), (3, 1, 0), (4, None, 5), (5, -1, -1), (6, -65, 0)],
                                   "k int, lo bigint, hi bigint")
    got = sorted(map(tuple, range_join(facts, ranges, "v", "lo", "hi").select("id", "k").collect()))
    assert got == [(1, 1), (2, 1), (2, 2), (3, 1), (3, 6), (5, 1), (5, 5), (5, 6)]
    assert range_join(facts, ranges.limit(0), "v", "lo", "hi").count() == 0


def test_any_code_join_follows_the_collation(spark):
    facts = spark.createDataFrame([(1, "usa"), (2, "Us  "), (3, " us")], "id int, code string")
    dim = spark.createDataFrame([("USA ", "us", "d")], "long_code string, short_code string, d string")
    out = dict(any_code_join(facts, dim, "code", ["long_code", "short_code"]).select("id", "d").collect())
    assert out == {1: "d", 2: "d", 3: None}           # leading blanks do matter


def test_any_code_join_equal_codes_match_once_and_shared_code_fans_out(spark):
    facts = spark.createDataFrame([(1, "A"), (2, "1"), (3, "Z"), (4, None)], "id int, code string")
    dim = spark.createDataFrame([("A", "A", "da"), ("B", "1", "db"), ("C", "1", "dc")],
                                "long_code string, short_code string, d string")
    fast = any_code_join(facts, dim, "code", ["long_code", "short_code"], "left").select("id", "d")
    facts.createOrReplaceTempView("f3")
    dim.createOrReplaceTempView("d3")
    naive = spark.sql("select id, d from f3 left join d3 on d3.long_code = f3.code or d3.short_code = f3.code")
    assert sorted(map(tuple, fast.collect()), key=str) == sorted(map(tuple, naive.collect()), key=str)
    assert fast.where("id = 1").count() == 1      # long = short = 'A' matches once
    assert fast.where("id = 2").count() == 2      # short code '1' shared by two rows


def test_first_by_order_puts_null_date_first(spark):
    rows = [("f1", dt.datetime(2020, 1, 1), "VIEW"), ("f1", None, "CLICK"),
            ("f2", dt.datetime(2020, 1, 2), "B"), ("f2", dt.datetime(2020, 1, 1), "C"),
            ("f3", dt.datetime(2020, 1, 1), "Y"), ("f3", dt.datetime(2020, 1, 1), "X")]
    df = spark.createDataFrame(rows, "f string, t timestamp_ntz, v string")
    out = dict(first_by_order(df, ["f"], "t", "v", "o").collect())
    assert out == {"f1": "CLICK", "f2": "C", "f3": "X"}


def test_single_value_lookup_errors_on_two_rows(spark):
    notes = spark.createDataFrame([("F1", "E1"), ("F2", "E2"), ("F2", "E3")], "f string, v string")
    files = spark.createDataFrame([("F1",), ("F3",)], "f string")
    ok = files.join(single_value_lookup(notes, ["f"], "v", "e"), "f", "left") \
              .select("f", check_single("e", "t").alias("e"))
    assert dict(ok.collect()) == {"F1": "E1", "F3": None}
    bad = spark.createDataFrame([("F2",)], "f string").join(
        single_value_lookup(notes, ["f"], "v", "e"), "f", "left").select(check_single("e", "t"))
    with pytest.raises(Exception, match="more than 1 value"):
        bad.collect()


def test_anti_on_equals_left_join_is_null(spark):
    left = spark.createDataFrame([(1, "01"), (2, "02"), (None, "01"), (3, None)], "c int, m string")
    right = spark.createDataFrame([(1, "01"), (None, "01"), (3, None)], "c int, m string")
    fast = anti_on(left, right, (left.c == right.c) & (left.m == right.m))
    left.createOrReplaceTempView("l4")
    right.createOrReplaceTempView("r4")
    naive = spark.sql("select l4.* from l4 left join r4 on l4.c = r4.c and l4.m = r4.m where r4.c is null")
    assert same_rows(fast, naive)
    assert fast.count() == 3


def test_conditional_sums_null_when_no_row(spark):
    df = spark.createDataFrame([("a", "F1", 1.0), ("a", "P", 2.0), ("b", "P", 4.0), ("c", None, 8.0)],
                               "f string, t string, v double")
    from ledgerline.functions.semantics import ci_starts
    out = {r.f: tuple(r)[1:] for r in conditional_sums(
        df, ["f"], "v", {"fee": ci_starts(F.col("t"), "F"), "svc": ~ci_starts(F.col("t"), "F"),
                         "tot": None}).collect()}
    assert out == {"a": (1.0, 2.0, 3.0), "b": (None, 4.0, 4.0), "c": (None, None, 8.0)}
