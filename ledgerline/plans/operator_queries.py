"""Operator-level queries: each source operator exercised on its own, over
whole role tables, so it can be checked against its literal SQL form.
in the README.)"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.semantics import (
    band_label, blank_or, ci_eq, ci_ne, ci_norm, ci_not_starts, ci_starts, date_to_key, days_between,
    first_of_month, int_key_to_date, is_blank, isnull_typed, MONEY, PERCENT, relabel_band,
    tier_rate, ts_lit,
)
from ledgerline.operators.aggregates import distinct_rows
from ledgerline.operators.joins import any_code_join, anti_on, range_join
from ledgerline.plans import adjudication, commission, extract, fixture
from ledgerline.sources.roles import Roles
from ledgerline.sources.sinks import read_current, replace_load, run_folder

col = F.col

LOOKUP_FILE = "AF00000007"
CLOSED_FROM = dt.datetime(1996, 1, 1)
CLOSED_TO = dt.datetime(1997, 6, 30)
CUTOFF = dt.date(1997, 1, 1)


def _q(fn):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Roles(spark, sf_dir))
    q.__doc__ = fn.__doc__
    return q


def scan_lookup(r: Roles) -> DataFrame:
    """``select *`` of one file's detail lines (key filter pushed
    into the scan) that are priced, i.e. a flag-style equality."""
    return extract.lookup_rows(r.request_detail, "file_no", LOOKUP_FILE)


def scan_lookup_international(r: Roles) -> DataFrame:
    """``select *`` of the same file's international detail rows."""
    return extract.lookup_rows(r.detail_international, "file_no", LOOKUP_FILE)


def commission_maths(r: Roles) -> DataFrame:
    """The rate maths of the regular branch over its
    report-row sums (round, NULL-as-zero rate, percent text, exact pay)."""
    return commission.commission_regular(r, fixture.COMMISSION).select(
        "client_key", "billing_date_key", "account_aging_in_days", "commissionable_amount",
        "amount_payable_percentage", "commission_to_be_paid")


def replace_load_query(r: Roles) -> DataFrame:
    """Build staging, then replace the report table in one write
    (new version folder + pointer) and read back what was published."""
    staged = commission.commission_tables(r, fixture.COMMISSION)
    mart = commission.mart_with_audit_tags(r, fixture.COMMISSION, staged=staged).drop("audit_inserted_date")
    target = run_folder(r.spark, "report_table")
    replace_load(mart, target)
    return read_current(r.spark, target)


def ci_filter(r: Roles) -> DataFrame:
    """Collation-aware = / <> / LIKE / NOT LIKE with AND/OR."""
    d = r.request_detail
    keep = (ci_ne("status", "NOTREQ") & ci_ne("status", "SUSPENDED")
            & (ci_starts("type_code", "f") | ci_eq("type_code", "p "))
            & ci_not_starts("report_type", "brand#1"))
    return d.where(keep).select("file_no", "line_no", "type_code", "status", "report_type")


def blank_fallback(r: Roles) -> DataFrame:
    """NULL-or-blank tests with fallbacks over every detail line."""
    d = r.request_detail.join(r.detail_international, ["file_no", "line_no"], "left")
    return d.select(
        "file_no", "line_no",
        blank_or("report_desc", col("report_type")).alias("component"),
        F.when(is_blank("country"), F.lit("USA")).otherwise(col("country")).alias("country"),
        col("report_desc").isNull().alias("desc_is_null"))


def code_labels(r: Roles) -> DataFrame:
    """CASE with ELSE (package, trouble flag) and without
    (status label: NULL for anything else)."""
    q = r.request
    return q.select(
        "file_no",
        F.when(ci_eq("package", "NONE"), F.lit("A LA CARTE")).otherwise(col("package")).alias("package"),
        F.when(col("trouble_flag") == 1, F.lit("Y")).otherwise(F.lit("N")).alias("troubled_file"),
        F.when(ci_eq("status", "CLOSED"), F.lit("Closed"))
         .when(ci_eq("status", "PENDING"), F.lit("Open")).alias("status_label"))


def date_ranges(r: Roles) -> DataFrame:
    """Closed range, open range (next-day bound) and a
    truncated-date cut-off, as flags over every request."""
    c = col("date_completed")
    return r.request.select(
        "file_no", "date_completed",
        ((c >= ts_lit(CLOSED_FROM)) & (c <= ts_lit(CLOSED_TO))).alias("in_closed_range"),
        ((c > ts_lit(CLOSED_FROM)) & (c < ts_lit(CLOSED_TO + dt.timedelta(days=1)))).alias("in_open_range"),
        (F.to_date(c) <= F.lit(CUTOFF)).alias("on_or_before_cutoff"))


def star_join(r: Roles) -> DataFrame:
    """Billed lines joined to usage type, live file, component."""
    return commission.billed_lines(r).select(
        "file_key", "client_key", "billing_date_key", "billing_date",
        col("amount").cast("decimal(38,4)").alias("amount"),
        col("fee_amount").cast("decimal(38,4)").alias("fee_amount"))


def distinct_derived_join(r: Roles) -> DataFrame:
    """Requests joined to DISTINCT detail lines left-joined to their
    international country (composite key)."""
    d = r.request_detail.join(r.detail_international, ["file_no", "line_no"], "left")
    d = distinct_rows(d, ["file_no", "line_no", "unit_price", "country"])
    return commission.staged(r, r.request.select("file_no", "first_name").join(d, "file_no"), "distinct_derived_join")


def _money4(c: str) -> F.Column:
    return col(c).cast("decimal(38,4)").alias(c)


def _money2(c: str) -> F.Column:
    return col(c).cast("decimal(38,2)").alias(c)


def left_join_fees(r: Roles) -> DataFrame:
    """Per client-day measures after the per-file fee left join."""
    cd = commission.client_days(r, with_billing_date=False)
    return cd.select("client_key", "billing_date_key", _money4("actual"), _money4("fees"),
                     _money2("misc"), _money2("background"))


def band_outer_join(r: Roles) -> DataFrame:
    """Regular-branch L2 with one row for each band that has none."""
    l2 = commission.band_l2(r, fixture.COMMISSION, branches=(commission.REGULAR,))
    return l2.select("commission_key", "client_key", "billing_date_key",
                     _money4("actual"), _money4("fees"))


def month_key_join(r: Roles) -> DataFrame:
    """Client-day rows LEFT JOIN adjustments on client + month + year
    of the int date key (adjustments pre-aggregated, applied as weights)."""
    cd = commission.client_day(commission.fact_grain(r), with_billing_date=False)
    adj = commission.adjustments_by(r, "client_key")
    x = commission.staged(r, commission._join_adjustments(cd, adj, "client_key"), "month_key_join")
    w = F.coalesce(col("adj_rows"), F.lit(1)).cast("decimal(10,0)")
    return x.select(
        "client_key", "billing_date_key",
        F.coalesce(col("adj_rows"), F.lit(0)).cast("bigint").alias("adj_rows"),
        (col("actual") * w).cast("decimal(38,4)").alias("actual_total"),
        F.coalesce(col("adj_sum"), F.lit(0).cast(MONEY)).cast("decimal(38,2)").alias("adjustment_total"),
        F.coalesce(col("bad_sum"), F.lit(0).cast(MONEY)).cast("decimal(38,2)").alias("bad_debt_total"))


def _client_day_banded(r: Roles) -> DataFrame:
    cd = commission.client_days(r, with_billing_date=False)
    x = cd.join(r.client.select("client_key", "business_start_date"), "client_key")
    x = x.withColumn("age", days_between(col("business_start_date"),
                                         int_key_to_date(col("billing_date_key"))))
    return range_join(x, r.commission_band, "age", "account_age_min", "account_age_max")


def range_band_join(r: Roles) -> DataFrame:
    """Client age in days BETWEEN the band bounds (all bands)."""
    return _client_day_banded(r).select("client_key", "billing_date_key", "age", "commission_key")


def band_labels(r: Roles) -> DataFrame:
    """Band label text and its published form."""
    x = _client_day_banded(r)
    label = band_label(col("account_age_min"), col("account_age_max"))
    return x.select("client_key", "billing_date_key", "commission_key",
                    label.alias("label"), relabel_band(label).alias("published_label"))


def any_code_join_query(r: Roles) -> DataFrame:
    """Country description by long OR short code."""
    x = any_code_join(r.detail_international, r.country_code, "country",
                      ["long_code", "short_code"], "left")
    return x.select("file_no", "line_no", "country", "long_code", "description")


def unmatched_adjustments(r: Roles) -> DataFrame:
    """Adjustments of client-months with no billed day,
    keyed by the first of the month, with the signed adjustment maths."""
    have = commission.billed_months(r)
    fi = r.invoice_adjustment
    x = anti_on(fi, have, (fi["client_key"] == have["h_client"])
                & (fi["adjustment_month"] == have["h_month"])
                & (fi["adjustment_year"] == have["h_year"]))
    zero = F.lit(0).cast(MONEY)
    bad, amt, fee = (F.coalesce(col(c), zero) for c in ("bad_debt_amount", "amount", "fee"))
    return x.select(
        "client_key", "adjustment_month", "adjustment_year",
        date_to_key(first_of_month(col("adjustment_year"), col("adjustment_month"))).alias("billing_date_key"),
        (amt - fee - bad).cast(MONEY).alias("adjustment_amount"),
        (-(bad + (amt - fee))).cast("double").alias("commissionable_amount"))


def single_value_lookup_query(r: Roles) -> DataFrame:
    """Scalar sub-query that must find at most one EMPID row per file."""
    from ledgerline.operators.joins import check_single
    x = r.request.select("file_no").join(adjudication.employee_ids(r), "file_no", "left")
    return x.select("file_no", check_single("employee_id", "EMPID per file").alias("employee_id"))


def any_row_lookup_query(r: Roles) -> DataFrame:
    """TOP 1 without ORDER BY, fixed to min / max."""
    q = r.request
    st = adjudication.status_descriptions(r)
    x = q.join(adjudication.adjudication_facts(r, q), ["file_no", "client_req_status", "account_no"], "left")
    x = x.join(st, (ci_norm(x["client_req_status"]) == st["st_key"]) & (x["account_no"] == st["st_account"]), "left")
    return (x.join(adjudication.applicant_emails(r), "file_no", "left")
            .select("file_no", "applicant_email", "flag_description", "current_adj_date"))


def first_differing_status(r: Roles) -> DataFrame:
    """Earliest adjudication whose status differs from the current one."""
    q = r.request.select("file_no", "client_req_status", "account_no")
    return (q.join(adjudication.adjudication_facts(r, q), ["file_no", "client_req_status", "account_no"], "left")
            .select("file_no", "original_adj"))


def constant_rate_column(r: Roles) -> DataFrame:
    """The uncorrelated TOP-1 sub-query (pay percent of band 5) as a
    column of every special client."""
    k5 = (r.commission_band.where(col("commission_key") == 5)
          .select("account_pay_percent").limit(1).scalar())
    return commission.special_clients(r).select(
        "client_key", "company_name1", k5.alias("key5_pay_percent"))


def fee_service_totals(r: Roles) -> DataFrame:
    """Fee / service / total price per request in one pass."""
    return r.request.select("file_no").join(adjudication.cost_totals(r), "file_no", "left")


def three_level_rollup(r: Roles) -> DataFrame:
    """A1 A2 A3: the regular branch's three-level cascade, raw sums."""
    l3 = commission.band_l3(r, commission.band_l2(r, fixture.COMMISSION, branches=(commission.REGULAR,)))
    return commission.staged(r, l3, "band_l3").select("rate_key", "company_name1", "client_key", "exec_trim", "billing_date_key",
                     "label", "business_start_date", "site_number",
                     *[col(c).cast("decimal(38,4)").alias(c)
                       for c in ("actual", "fees", "misc", "background", "adj", "bad")])


def group_by_expression(r: Roles) -> DataFrame:
    """GROUP BY trimmed executive (under the collation, shown by its
    smallest spelling) and ISNULL(percent, 0)."""
    cd = commission.client_day(commission.fact_grain(r), with_billing_date=False)
    x = cd.join(r.client, "client_key").withColumn("name", F.trim("account_executive"))
    # spellings first: MIN of a text makes Spark sort what it groups
    spelled = x.groupBy("name", isnull_typed(col("commission_percent"), 0, PERCENT).alias("percent")).agg(
        F.sum("actual").alias("actual"), F.count(F.lit(1)).alias("client_days"))
    out = spelled.groupBy(ci_norm("name").alias("name_key"), "percent").agg(
        F.min("name").alias("account_executive"), F.sum("actual").cast("decimal(38,4)").alias("actual"),
        F.sum("client_days").alias("client_days"))
    return commission.staged(r, out.select("percent", "account_executive", "actual", "client_days"), "group_by_expression")


def rate_tiers(r: Roles) -> DataFrame:
    """Tier rate by client age from the site's bucket card."""
    cd = commission.client_days(r, with_billing_date=True)
    x = (cd.join(r.client.select("client_key", "business_start_date", ci_norm("site_number").alias("site_number")),
                 "client_key")
         .join(r.site_bucket.withColumn("site_number", ci_norm("site_number")), "site_number"))
    age = days_between(col("business_start_date"), col("billing_date"))
    rates = [col(c) for c in ("yr1_rate", "yr2_rate", "yr3_rate", "perpetual_rate")]
    return x.select("client_key", "billing_date_key", "bucket_month", age.alias("age_days"),
                    tier_rate(age, *rates).alias("curr_rate"))


OPERATOR_QUERIES = {
    "scan_lookup": _q(scan_lookup),
    "scan_lookup_international": _q(scan_lookup_international),
    "commission_maths": _q(commission_maths),
    "replace_load": _q(replace_load_query),
    "ci_filter": _q(ci_filter),
    "blank_fallback": _q(blank_fallback),
    "code_labels": _q(code_labels),
    "date_ranges": _q(date_ranges),
    "star_join": _q(star_join),
    "distinct_derived_join": _q(distinct_derived_join),
    "left_join_fees": _q(left_join_fees),
    "band_outer_join": _q(band_outer_join),
    "month_key_join": _q(month_key_join),
    "range_band_join": _q(range_band_join),
    "band_labels": _q(band_labels),
    "any_code_join": _q(any_code_join_query),
    "unmatched_adjustments": _q(unmatched_adjustments),
    "single_value_lookup": _q(single_value_lookup_query),
    "any_row_lookup": _q(any_row_lookup_query),
    "first_differing_status": _q(first_differing_status),
    "constant_rate_column": _q(constant_rate_column),
    "fee_service_totals": _q(fee_service_totals),
    "three_level_rollup": _q(three_level_rollup),
    "group_by_expression": _q(group_by_expression),
    "rate_tiers": _q(rate_tiers),
}
