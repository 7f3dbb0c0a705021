"""Hand-computed checks of the commission procedure's fan-out semantics on a
tiny literal warehouse (SURVEY traps T2-T6, T8)."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import commission as c
from ledgerline.plans.config import CommissionConfig
from ledgerline.sources.roles import Roles

CFG = CommissionConfig(regular_until=dt.date(2016, 3, 31), bucket_from=dt.date(2016, 4, 1),
                       run_ts=dt.datetime(2020, 2, 2, 3, 0))

M = "decimal(18,2)"
R = "decimal(4,2)"


class LiteralRoles(Roles):
    def __init__(self, spark, frames):
        self.spark = spark
        self.__dict__.update(frames)
        self.__dict__["billed_component"] = self.billed_line.join(self.component, "component_key")


def line(spark, rows):
    return spark.createDataFrame(
        [(f, cl, 100, 3, D(q), D(p), d, int(d.strftime("%Y%m%d")), 0, 1) for f, cl, q, p, d in rows],
        f"file_key bigint, client_key bigint, component_key bigint, usage_type_key int, "
        f"quantity {M}, unit_price {M}, billing_date date, billing_date_key int, is_delete int, "
        f"is_billed int")


@pytest.fixture(scope="module")
def roles(spark):
    d = dt.date
    frames = {
        "billed_line": line(spark, [
            (10, 1, "1", "100", d(2016, 1, 5)), (10, 1, "1", "100", d(2016, 1, 6)),   # T3
            (20, 2, "1", "100", d(2016, 6, 1)),                                      # T2
            (30, 3, "2", "50", d(2016, 6, 1)),                                       # T5
        ]),
        "usage_type": spark.createDataFrame([(3, "Package")], "usage_type_key int, usage_type_name string"),
        "file": spark.createDataFrame([(10, 0), (20, 0), (30, 0)], "file_key bigint, is_delete int"),
        "component": spark.createDataFrame([(100, 0)], "component_key bigint, charge_as_fee int"),
        "client": spark.createDataFrame([
            (1, "Co1", "REG", None, "  Exec A ", 7, d(2015, 6, 1), "S1"),
            (2, "Co2", "OTH", None, "  Exec B", 8, d(2016, 5, 1), "S2"),
            (3, "Co3", "spc", D("12.00"), "Exec C", 9, d(2016, 5, 1), "S2"),
        ], "client_key bigint, company_name1 string, commission_type string, "
           "commission_percent decimal(5,2), account_executive string, account_executive_id int, "
           "business_start_date date, site_number string"),
        "file_fees": spark.createDataFrame([(10, D("5.00"), D("1.00"))],
                                           f"file_key bigint, miscellaneous_fees {M}, background_fees {M}"),
        "invoice_adjustment": spark.createDataFrame([
            (1, 7, "01", "2016", D("2.00"), D("1.00"), D("0"), D("0")),      # T4: two rows
            (1, 7, "01", "2016", D("3.00"), None, D("0"), D("0")),
            (2, 8, "06", "2016", D("4.00"), D("0"), D("0"), D("0")),         # T2: per bucket month
            (1, 7, "02", "2016", D("9.00"), D("5.00"), D("50"), D("10")),    # adjustment-only
        ], f"client_key bigint, account_executive_id int, adjustment_month string, "
           f"adjustment_year string, adjustment_amount {M}, bad_debt_amount {M}, amount {M}, fee {M}"),
        "site_bucket": spark.createDataFrame([
            ("S2", 1, "Bucket A", D("10"), D("5"), D("3"), D("1")),
            ("S2", 2, "Bucket A", D("10"), D("5"), D("3"), D("1")),
        ], f"site_number string, bucket_month int, bucket_name string, yr1_rate {R}, yr2_rate {R}, "
           f"yr3_rate {R}, perpetual_rate {R}"),
        "commission_band": spark.createDataFrame(
            [(1, 0, 365, D("10.00"), 0), (2, 366, 730, D("7.50"), 0)],
            "commission_key int, account_age_min int, account_age_max int, "
            "account_pay_percent decimal(5,2), is_delete int"),
        "new_business_band": spark.createDataFrame([(0, 365), (366, 730)],
                                                   "start_range int, end_range int"),
    }
    return LiteralRoles(spark, frames)


def rows_by(df, *keys):
    if len(keys) == 1:
        return {r[keys[0]]: r for r in df.collect()}
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_regular_fees_per_day_row_and_adjustments_repeat(roles):
    out = rows_by(c.commission_regular(roles, CFG), "client_key", "billing_date_key")
    assert set(out) == {(1, 20160105), (1, 20160106), (None, None)}
    for day in (20160105, 20160106):
        r = out[(1, day)]
        # one line of 100 per day, repeated for each of the 2 adjustments (T4)
        assert r.actual_amount == D("200.00")
        # the file's fees (5 + 1) count once per (file, day) row (T3), x2 adjustments
        assert r.miscellaneous_fee == D("10.00")
        assert r.adjustment_amount == D("5.00") and r.bad_debt_amount == D("1.00")
        assert r.commissionable_amount == 188.0
        assert r.amount_payable_percentage == "10.00"
        assert r.commission_to_be_paid == D("18.20")   # (188 - 5 - 1) x 10%
        assert r.account_executive == "Exec A" and r.commission_type == "Regular"
        assert r.account_aging_in_days == "0 - 365"
    empty = out[(None, None)]                          # band without billings (J6)
    assert empty.account_aging_in_days == "366 - 730"
    assert empty.amount_payable_percentage == "7.50"
    assert empty.actual_amount == D("0.00") and empty.commission_to_be_paid == D("0.00")


def test_bucket_months_double_count(roles):
    out = rows_by(c.commission_bucket(roles, CFG), "client_key")
    r2 = out[2]
    assert r2.actual_amount == D("200.00")            # two bucket months (T2)
    assert r2.adjustment_amount == D("8.00")          # the one adjustment, once per month row
    assert r2.commission_to_be_paid == D("19.20")     # (200 - 8) x 10% (age 31 -> year-1 rate)
    assert r2.commission_type == "Bucket A"
    assert (r2.yr1_rate, r2.yr2_rate, r2.yr3_rate, r2.perpetual_rate) == (
        D("10.00"), D("5.00"), D("3.00"), D("1.00"))
    assert out[3].actual_amount == D("200.00")        # special client is bucketed too (T5)


def test_special_client_also_in_branch_one(roles):
    out = rows_by(c.commission_special(roles, CFG), "client_key")
    r3 = out[3]
    assert r3.actual_amount == D("100.00")
    assert r3.amount_payable_percentage == "12.00"
    assert r3.commission_to_be_paid == D("12.00")
    assert r3.commission_type == "Special"


def test_mart_adjustment_only_rows_and_audit(roles):
    staged = c.commission_staged(roles, CFG)
    mart = c.commission_mart(roles, CFG, staged=staged)
    adj = [r for r in mart.collect() if r.actual_amount is None]
    assert len(adj) == 1                               # Jan / June adjustments have report rows
    a = adj[0]
    assert (a.client_key, a.billing_date_key) == (1, 20160201)
    assert a.commission_type == "REGULAR"
    assert a.adjustment_amount == D("35.00")           # 50 - 10 - 5
    assert a.commissionable_amount == -45.0            # -(5 + (50 - 10))
    assert a.commission_to_be_paid == D("-4.50")       # -((5 + 50 - 10) x 10) / 100
    assert a.account_executive == "  Exec A "          # not trimmed
    assert a.account_aging_in_days == "0 - 365"        # not relabelled
    assert a.audit_inserted_package_key == CFG.package_key
    loaded = c.mart_with_audit_tags(roles, CFG, staged=staged)
    audit = c.load_audit(loaded, CFG.run_ts.date()).first()
    n_staged = staged.count()
    assert audit.sourcecount == n_staged == audit.extractrowcount
    assert audit.destinationfinalrowcount == n_staged + 1 == audit.insertcount
    assert audit.updatecount is None and audit.nochangerowcount is None
    # staged count = sum of branch counts; adjustment-only keys disjoint from staged
    assert n_staged == sum(f(roles, CFG).count() for f in (
        c.commission_special, c.commission_regular, c.commission_bucket))


def test_null_type_in_staging_fails(spark, roles):
    bad = LiteralRoles(spark, {**roles.__dict__, "site_bucket": roles.site_bucket.selectExpr(
        "site_number", "bucket_month", "cast(null as string) as bucket_name", "yr1_rate",
        "yr2_rate", "yr3_rate", "perpetual_rate")})
    with pytest.raises(Exception, match="NOT NULL"):
        c.commission_bucket(bad, CFG).collect()


def with_frames(spark, roles, **frames):
    return LiteralRoles(spark, {**roles.__dict__, **frames})


def test_repeated_dimension_rows_repeat_amounts_but_not_file_fees(spark, roles):
    """File fees are attached after the source has grouped by file, client,
    label, bucket and month, so only line amounts repeat."""
    own = with_frames(
        spark, roles,
        file_fees=spark.createDataFrame([(20, D("5.00"), D("1.00"))],
                                        f"file_key bigint, miscellaneous_fees {M}, background_fees {M}"),
        site_bucket=roles.site_bucket.where("bucket_month = 1"))

    def client_2(r):
        return rows_by(c.commission_bucket(r, CFG), "client_key")[2]

    one = client_2(own)
    assert (one.actual_amount, one.miscellaneous_fee, one.commission_to_be_paid) == (D("100.00"), D("5.00"), D("9.00"))
    for twice in ({"site_bucket": own.site_bucket.unionByName(own.site_bucket)},
                  {"new_business_band": own.new_business_band.unionByName(own.new_business_band)},
                  {"client": own.client.unionByName(own.client)}):
        r = client_2(with_frames(spark, own, **twice))
        assert (r.actual_amount, r.miscellaneous_fee) == (D("200.00"), D("5.00")), twice
        assert (r.commissionable_amount, r.adjustment_amount) == (194.0, D("4.00"))
        assert r.commission_to_be_paid == D("19.00")   # (200 - 5 - 1 - 4) x 10%


def test_repeated_clients_in_the_regular_branch(spark, roles):
    twice = with_frames(spark, roles, client=roles.client.unionByName(roles.client))
    r = rows_by(c.commission_regular(twice, CFG), "client_key", "billing_date_key")[(1, 20160105)]
    assert r.actual_amount == D("400.00")              # two client rows x two adjustments
    assert r.miscellaneous_fee == D("10.00")           # the file's fees once, x two adjustments


def test_a_repeated_band_key_repeats_its_report_rows(spark, roles):
    bands = roles.commission_band
    twice = with_frames(spark, roles, commission_band=bands.unionByName(bands.where("commission_key = 1")))
    r = rows_by(c.commission_regular(twice, CFG), "client_key", "billing_date_key")[(1, 20160105)]
    # both rows match the line (x2), both take the group (x2), two adjustments (x2)
    assert r.actual_amount == D("800.00") and r.miscellaneous_fee == D("20.00")


def test_bucket_sites_are_joined_under_the_collation(spark, roles):
    low = roles.site_bucket.selectExpr("lower(site_number) || '  ' as site_number", "bucket_month", "bucket_name",
                                       "yr1_rate", "yr2_rate", "yr3_rate", "perpetual_rate")
    out = rows_by(c.commission_bucket(with_frames(spark, roles, site_bucket=low), CFG), "client_key")
    assert out[2].actual_amount == D("200.00")


def test_the_rate_is_not_rounded_before_it_is_applied(spark, roles):
    bands = spark.createDataFrame([(1, 0, 365, D("7.125"), 0)],
                                  "commission_key int, account_age_min int, account_age_max int, "
                                  "account_pay_percent decimal(6,3), is_delete int")
    r = with_frames(spark, roles, commission_band=bands,
                    billed_line=line(spark, [(30, 1, "1", "100000", dt.date(2016, 3, 1))]))
    row = rows_by(c.commission_regular(r, CFG), "client_key")[1]
    assert row.amount_payable_percentage == "7.13"     # only the text is rounded
    assert row.commission_to_be_paid == D("7125.00")


def test_billing_dates_with_a_time_part_are_one_day(spark, roles):
    timed = roles.billed_line.where("file_key = 20").withColumn(
        "billing_date", F.expr("timestamp_ntz '2016-06-01 08:00:00'"))
    both = timed.unionByName(timed.withColumn("billing_date", F.expr("timestamp_ntz '2016-06-01 17:00:00'")))
    fees = spark.createDataFrame([(20, D("5.00"), D("1.00"))],
                                 f"file_key bigint, miscellaneous_fees {M}, background_fees {M}")
    r = with_frames(spark, roles, billed_line=both, file_fees=fees, site_bucket=roles.site_bucket.where("bucket_month = 1"))
    row = rows_by(c.commission_bucket(r, CFG), "client_key")[2]
    assert (row.actual_amount, row.miscellaneous_fee) == (D("200.00"), D("5.00"))


def test_only_rows_of_the_run_day_count_as_inserted(spark, roles):
    staged = c.commission_staged(roles, CFG)
    loaded = c.mart_with_audit_tags(roles, CFG, staged=staged)
    mixed = loaded.withColumn("audit_inserted_date", F.when(F.col("client_key") == 1, F.expr("timestamp_ntz '2020-02-01 23:59:59'"))
                              .otherwise(F.col("audit_inserted_date")))
    audit = c.load_audit(mixed, CFG.run_ts.date()).first()
    old = loaded.where("client_key = 1").count()
    assert old > 0 and audit.insertcount == audit.destinationfinalrowcount - old
