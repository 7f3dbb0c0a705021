"""A hot key (a third of all billed lines on one component): AQE splits the
skewed join partition and the fact grain is unchanged."""

import contextlib

from pyspark.sql import functions as F

from ledgerline.plans import commission
from ledgerline.sources.roles import Roles

from .conftest import SF_SMALL

# thresholds scaled down to the fixture (defaults are sized for 100+ MB partitions)
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def hot_roles(spark):
    r = Roles(spark, SF_SMALL)
    li = r.t.lineitem
    r.t.__dict__["lineitem"] = li.withColumn(
        "l_partkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_partkey")))
    return r


@contextlib.contextmanager
def small_thresholds(spark):
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def joins_of(plan, name):
    """The plan's lines of sort-merge joins on a column."""
    return [line for line in plan.splitlines() if "SortMergeJoin" in line and name in line]


def test_hot_component_is_split_and_results_unchanged(spark):
    expected = commission.fact_grain(hot_roles(spark)).collect()
    with small_thresholds(spark):
        g = commission.fact_grain(hot_roles(spark))
        got = g.collect()
        plan = final_plan(g)
    assert "SortMergeJoin(skew=true)" in plan
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


def test_hot_file_is_split_where_fees_are_joined(spark):
    """A third of all lines on one file: the join with the grouped fees is split."""
    r = Roles(spark, SF_SMALL)
    li = r.t.lineitem
    r.t.__dict__["lineitem"] = li.withColumn(
        "l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("l_orderkey")))
    expected = commission.fact_grain(r).collect()
    with small_thresholds(spark):
        g = commission.fact_grain(r)
        got = g.collect()
        plan = final_plan(g)
    fees = [line for line in joins_of(plan, "file_key") if "LeftOuter" in line]
    assert fees and all("skew=true" in line for line in fees)
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


def test_hot_executive_month_is_split(spark, tmp_path):
    """A third of all rows on one executive and month: the join with the
    grouped adjustments is split."""
    r = Roles(spark, SF_SMALL)
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 25).cast("int").alias("account_executive_id"),
        F.when(F.col("id") % 3 == 0, 19950301 + F.col("id") % 28)
         .otherwise(19920101 + F.col("id") % 6 * 10_000 + F.col("id") % 12 * 100).cast("int").alias("billing_date_key"), "id")
    rows.write.parquet(str(tmp_path / "l2"))
    l2 = spark.read.parquet(str(tmp_path / "l2"))

    def join():
        return commission._join_adjustments(l2, commission.adjustments_by(r, "account_executive_id"), "account_executive_id")

    expected = join().collect()
    with small_thresholds(spark):
        j = join()
        got = j.collect()
        plan = final_plan(j)
    assert "SortMergeJoin(skew=true)" in plan
    assert sorted(map(str, got)) == sorted(map(str, expected))
