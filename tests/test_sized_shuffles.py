"""Writes plan their shuffles by the size of their input, not by the session's
setting alone, and the procedure's client days are one table for all branches."""

import contextlib

import pytest
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.plans import commission, fixture, operator_queries
from ledgerline.plans.registry import queries
from ledgerline.sources import sinks
from ledgerline.sources.roles import Roles

from .conftest import SF_SMALL

PARTITIONS = "spark.sql.shuffle.partitions"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@pytest.fixture
def small_parts(monkeypatch):
    """The tables of sf0.001 count as large."""
    monkeypatch.setattr(session, "INPUT_BYTES_PER_PARTITION", 2_000)


def seen_by(monkeypatch):
    """The shuffle settings that hold while tables are written."""
    seen = []

    @contextlib.contextmanager
    def noted(df):
        with session.sized_shuffles(df):
            seen.append(int(df.sparkSession.conf.get(PARTITIONS)))
            yield

    monkeypatch.setattr(sinks, "sized_shuffles", noted)
    return seen


def test_partitions_follow_the_input(spark, small_parts):
    r = Roles(spark, SF_SMALL)
    n = session.partitions_for(r.t.lineitem)
    assert n == -(-session.input_bytes(r.t.lineitem) // 2_000) > int(spark.conf.get(PARTITIONS))
    assert session.partitions_for(r.usage_type) == int(spark.conf.get(PARTITIONS))


def test_settings_come_back_after_nested_and_failed_writes(spark, small_parts):
    before = [spark.conf.get(k) for k in (PARTITIONS, ADVISORY)]
    df = Roles(spark, SF_SMALL).t.lineitem
    with pytest.raises(RuntimeError), session.sized_shuffles(df), session.sized_shuffles(df):
        assert int(spark.conf.get(PARTITIONS)) == session.partitions_for(df) > int(before[0])
        assert session._bytes(spark.conf.get(ADVISORY)) <= session.SHUFFLED_BYTES_PER_PARTITION
        raise RuntimeError
    assert [spark.conf.get(k) for k in (PARTITIONS, ADVISORY)] == before


SCANNED = "spark.sql.files.maxPartitionBytes"


def test_scans_are_cut_by_size(spark, monkeypatch):
    def lines():
        return Roles(spark, SF_SMALL).t.lineitem

    whole, before = lines().rdd.getNumPartitions(), spark.conf.get(SCANNED)
    with session.sized_shuffles(lines()):
        assert session._bytes(spark.conf.get(SCANNED)) <= session.SCANNED_BYTES_PER_PARTITION < session._bytes(before)
    monkeypatch.setattr(session, "SCANNED_BYTES_PER_PARTITION", session.input_bytes(lines()) // 10)
    with session.sized_shuffles(lines()):
        assert lines().rdd.getNumPartitions() >= 10 > whole
    assert spark.conf.get(SCANNED) == before


def test_a_finer_scan_setting_stays(spark):
    before = spark.conf.get(SCANNED)
    spark.conf.set(SCANNED, "1m")
    try:
        with session.sized_shuffles(Roles(spark, SF_SMALL).t.lineitem):
            assert session._bytes(spark.conf.get(SCANNED)) == 1 << 20
        assert spark.conf.get(SCANNED) == "1m"
    finally:
        spark.conf.set(SCANNED, before)


@pytest.mark.parametrize("name", ["special_variants", "staged_union", "group_by_expression", "group_by_variants", "month_key_join",
                                  "band_outer_join", "commission_maths", "commission_regular", "regular_variants",
                                  "three_level_rollup", "distinct_derived_join"])
def test_named_queries_are_written_from_bounded_scans(spark, monkeypatch, name):
    seen = []

    @contextlib.contextmanager
    def noted(df):
        with session.sized_shuffles(df):
            seen.append(session._bytes(spark.conf.get(SCANNED)))
            yield

    monkeypatch.setattr(sinks, "sized_shuffles", noted)
    queries()[name](spark, SF_SMALL)
    assert seen and max(seen) <= session.SCANNED_BYTES_PER_PARTITION


def scan_groupings(plan):
    """First lines of the partial groupings that run in a scan's own stage."""
    lines, found = plan.split("\n"), []
    for i, line in enumerate(lines):
        if "functions=[partial_" in line:
            below = next(x for x in lines[i + 1:] if "Exchange" in x or "Scan " in x)
            if "Scan " in below:
                found.append(line.strip())
    return found


def written_plans(monkeypatch):
    """The plans of the tables that are written."""
    plans = []

    @contextlib.contextmanager
    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        with session.sized_shuffles(df):
            yield

    monkeypatch.setattr(sinks, "sized_shuffles", noted)
    return plans


@pytest.mark.parametrize("name", ["group_by_expression", "group_by_variants", "band_outer_join", "commission_maths",
                                  "commission_regular", "regular_variants", "three_level_rollup", "staged_union"])
def test_file_fees_are_shuffled_before_they_are_grouped(spark, monkeypatch, name):
    """A row group is never split: grouped in the scan, its files would all be in one map."""
    plans = written_plans(monkeypatch)
    queries()[name](spark, SF_SMALL)
    fees = [p for p in plans if "keys=[file_key" in p and "miscellaneous_fees" in p]
    assert fees and not [x for p in fees for x in scan_groupings(p)]


def test_client_adjustments_are_shuffled_before_they_are_grouped(spark, monkeypatch):
    plans = written_plans(monkeypatch)
    commission.adjustments_by(Roles(spark, SF_SMALL), "client_key")
    commission.adjustments_by(Roles(spark, SF_SMALL), "account_executive_id")
    client, executive = plans
    spread = [x for x in client.split("\n") if "Exchange" in x and "REPARTITION_BY_COL" in x]
    assert len(spread) == 1 and "adjustment_month" in spread[0] and "bad_debt_amount" in spread[0]
    assert "REPARTITION_BY_COL" not in executive


def test_adjustment_sums_are_those_of_plain_grouping(spark):
    r = Roles(spark, SF_SMALL)
    for key in ("client_key", "account_executive_id"):
        r.invoice_adjustment.createOrReplaceTempView("adjustment_rows")
        want = spark.sql(f"""SELECT {key}, adjustment_month, adjustment_year, COUNT(*) AS adj_rows,
                                    SUM(COALESCE(adjustment_amount, 0)) AS adj_sum, SUM(COALESCE(bad_debt_amount, 0)) AS bad_sum
                             FROM adjustment_rows GROUP BY ALL""")
        got = commission.adjustments_by(r, key)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_hot_and_repeated_fees_keep_their_sums(spark):
    class Fees:
        pass

    r = Fees()
    r.spark = spark
    r.file_fees = spark.sql("""
        SELECT CASE WHEN id < 900 THEN 1 WHEN id < 950 THEN CAST(NULL AS bigint) ELSE id END AS file_key,
               CAST(CASE WHEN id % 3 > 0 THEN 1.25 END AS decimal(18,2)) AS miscellaneous_fees,
               CAST(id % 2 AS decimal(18,2)) AS background_fees, 'x' AS more FROM range(1000)""")
    got = {f: (n, str(m), str(b)) for f, n, m, b in commission.fees_per_file(r).collect()}
    assert len(got) == 52
    assert got[1] == (900, "750.00", "450.00") and got[None] == (50, "41.25", "25.00") and got[951] == (1, "0.00", "1.00")


@pytest.mark.parametrize("text, n", [("16KB", 16 << 10), ("64m", 64 << 20), ("67108864b", 64 << 20), ("5", 5), ("1g", 1 << 30)])
def test_sizes(text, n):
    assert session._bytes(text) == n


@pytest.mark.parametrize("name", [
    "commission_special", "left_join_fees", "special_variants", "staged_union", "group_by_expression", "group_by_variants",
    "month_key_join", "commission_maths", "commission_regular", "regular_variants", "three_level_rollup",
    "distinct_derived_join", "commission_adjustment_only"])
def test_named_queries_leave_no_shuffle_to_the_session(spark, small_parts, monkeypatch, name):
    seen = seen_by(monkeypatch)
    df = queries()[name](spark, SF_SMALL)
    assert seen and max(seen) > int(spark.conf.get(PARTITIONS))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan, plan


def test_band_outer_join_leaves_only_the_bands(spark, small_parts, monkeypatch):
    seen = seen_by(monkeypatch)
    df = operator_queries.band_outer_join(Roles(spark, SF_SMALL))
    assert max(seen) > int(spark.conf.get(PARTITIONS))
    assert "l_orderkey" not in df._jdf.queryExecution().executedPlan().toString()


def test_client_dates_hold_both_forms_of_client_day(spark):
    """Several dates under one billing key, a file without fees, one with two
    fee rows, null amounts and dates."""
    m = "decimal(18,2)"
    grain = spark.sql(f"""
        SELECT f AS file_key, c AS client_key, k AS billing_date_key, CAST(d AS date) AS billing_date,
               CAST(a AS decimal(38,4)) AS amount, CAST(a AS decimal(38,4)) AS fee_amount, CAST(n AS bigint) AS fee_rows,
               CAST(m AS decimal(28,2)) AS misc, CAST(b AS decimal(28,2)) AS background
        FROM VALUES (1, 1, 20160101, '2016-01-01', 5.5, 2, 7.25, 1), (1, 1, 20160101, '2016-01-02', 1, 2, 7.25, 1),
                    (1, 1, 20160101, NULL, 2, 2, 7.25, 1), (2, 1, 20160101, '2016-01-02', 3, 0, NULL, NULL),
                    (3, 1, 20160101, '2016-01-02', NULL, 1, 4, NULL), (3, 2, 20160103, '2016-01-02', NULL, 1, 4, NULL),
                    (4, NULL, 20160103, '2016-01-03', 8, 1, 2, 3) AS t(f, c, k, d, a, n, m, b)""")
    dates = commission.client_dates(grain)

    def rows(df):
        return sorted(map(str, df.select(sorted(df.columns)).collect()))

    for new, old in ((commission.by_client_day(dates), commission.client_day(grain, False)),
                     (dates.drop("misc_once", "background_once"), commission.client_day(grain, True))):
        assert rows(new) == rows(old)
        assert dict(new.dtypes) == dict(old.dtypes)
    assert m and dates.where(F.col("misc") != F.col("misc_once")).count()


def test_staged_rows_are_those_of_the_branches(spark):
    r = Roles(spark, SF_SMALL)
    cfg = fixture.COMMISSION
    grain = commission.fact_grain(r)
    parts = [commission.commission_special(r, cfg, commission.client_day(grain, False)),
             commission.commission_regular(r, cfg, commission.client_day(grain, False)),
             commission.commission_bucket(r, cfg, commission.client_day(grain, True))]
    one = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert sorted(map(str, one.collect())) == sorted(map(str, commission.commission_staged(r, cfg).collect()))
