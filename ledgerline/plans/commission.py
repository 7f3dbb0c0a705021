"""Executive-commission mart (the stored procedure's three staged branches,
the relabelled load, the adjustment-only rows and the audit row).

Grain is what makes the numbers: the source sums billed lines per file, then
per client-day after attaching file fees, then per report row after attaching
invoice adjustments, and every one of those left joins multiplies rows. Here
each fan-out is applied *algebraically* instead of by materialising the
pairs: the joined side is pre-aggregated to one row per join key carrying
``(row count, sums)``, and the other side's measures are multiplied by that
count. The results are identical (the oracle runs the literal joins), but no
step ever emits all pairs of a hot executive-month or a hot file, and every
shuffle moves partially aggregated rows.

Plan shape (one scan of the line facts, shared by the three branches):

    lines (component, then star join by file)  --left-->  fees per file
        -> per (file, client, day[, billing date])          [partitioned by file already]
        -> per (client, day[, billing date])                [partial agg]
        -> branch: client filter, age band (bucket range join), L2 grouping
        -> left join adjustments pre-aggregated per key     [1 row per key]
        -> report grouping (L3) and rate maths
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.semantics import (
    MONEY, PERCENT, RATE, band_label, ci_eq, ci_norm, ci_starts, date_to_key, days_between,
    first_of_month, int_key_to_date, isnull_typed, key_month, key_year,
    pay_amount, percent_text, relabel_band, tier_rate, ts_lit,
)
from ledgerline.operators.aggregates import spread_rows
from ledgerline.operators.joins import anti_on, range_join
from ledgerline.plans.config import CommissionConfig
from ledgerline.sources.contracts import ContractError, contract, enforced, insert_select
from ledgerline.sources.roles import Roles
from ledgerline.sources.sinks import run_folder, stage_table

col = F.col

# The report table's contract (target column order, types, limits).
STAGED = """
    client_key int, company_name varchar(255), site_number varchar(50), actual_amount decimal(18,2),
    fees_amount decimal(18,2), miscellaneous_fee decimal(18,2), bad_debt_amount decimal(18,2),
    adjustment_amount decimal(18,2), commissionable_amount double, amount_payable_percentage varchar(31),
    commission_to_be_paid decimal(18,2), commission_type varchar(55) not null, account_executive varchar(61),
    billing_date_key int, account_aging_in_days varchar(55), business_start_date timestamp_ntz,
    yr1_rate decimal(4,2), yr2_rate decimal(4,2), yr3_rate decimal(4,2), perpetual_rate decimal(4,2)"""
MART = STAGED.replace(" not null", "") + ", audit_inserted_package_key int"


def to_contract(df: DataFrame, ddl: str = STAGED, enforce: bool = True) -> DataFrame:
    """``INSERT (cols) SELECT`` where the select list names its columns like the
    target: target order, explicit casts, absent columns NULL, and the limits
    attached, so that they stay with the rows and every sink checks them. With
    ``enforce`` they are checked here as well."""
    schema = contract(ddl)
    odd = [c for c in df.columns if c not in schema.names]
    if odd:
        raise ContractError(f"not in the contract: {odd}")
    into = [n for n in schema.names if n in df.columns]
    out = insert_select(df.select(*into), schema, into)
    return enforced(out) if enforce else out


# ---------------------------------------------------------------------------
# shared fact grain
# ---------------------------------------------------------------------------

def billed_lines(r: Roles, with_fees: bool = False, folder: str | None = None) -> DataFrame:
    """Star join of the billed line facts (inner joins, flag filters in ON)
    with the line amount and the fee part of it.

    The component join comes first (``Roles.billed_component``); all joins
    after it, and the grouping of ``fact_grain``, use the file key, so lines
    are shuffled once by component and once by file.
    """
    lines = r.billed_component.where((col("is_delete") == 0) & (col("is_billed") == 1))
    live_files = r.file.where(col("is_delete") == 0).select("file_key")
    lines = lines.join(r.usage_type, "usage_type_key").join(live_files, "file_key")
    if with_fees:
        lines = lines.join(fees_per_file(r, folder), "file_key", "left")
    amount = col("quantity") * col("unit_price")
    is_fee = ci_starts("usage_type_name", "f") | (col("charge_as_fee") == 1)
    fee_cols = ["fee_rows", "misc", "background"] if with_fees else []
    return lines.select(
        "file_key", "client_key", "billing_date_key", F.to_date("billing_date").alias("billing_date"),
        amount.alias("amount"),
        F.when(is_fee, amount).otherwise(F.lit(0).cast(MONEY)).alias("fee_amount"),
        *fee_cols,
    )


def billed_months(r: Roles) -> DataFrame:
    """Distinct (client, month, year) with a billed line, as texts of the
    billing key: the same joins as ``billed_lines``, as existence tests over
    the key columns only."""
    lines = r.billed_component.where((col("is_delete") == 0) & (col("is_billed") == 1))
    live_files = r.file.where(col("is_delete") == 0).select("file_key")
    return (lines.join(r.usage_type.select("usage_type_key"), "usage_type_key", "left_semi")
            .join(live_files, "file_key", "left_semi")
            .select(col("client_key").alias("h_client"), key_month(col("billing_date_key")).alias("h_month"),
                    key_year(col("billing_date_key")).alias("h_year")).distinct())


def _grouped_side(r: Roles, df: DataFrame, name: str, folder: str | None) -> DataFrame:
    """A grouped table that is about to be joined, written first: a join straight
    on top of a grouping cannot be split at a hot key, one on a table can."""
    folder = run_folder(r.spark, name) if folder is None else folder
    return stage_table(df, os.path.join(folder, f"{name}-{uuid.uuid4().hex[:8]}"))


def fees_per_file(r: Roles, folder: str | None = None) -> DataFrame:
    """File fees pre-aggregated: ``(file, fee rows, sum misc, sum background)``."""
    rows = spread_rows(r.file_fees.select("file_key", "miscellaneous_fees", "background_fees"))
    fees = rows.groupBy("file_key").agg(
        F.count(F.lit(1)).alias("fee_rows"),
        F.sum(F.coalesce(col("miscellaneous_fees"), F.lit(0).cast(MONEY))).alias("misc"),
        F.sum(F.coalesce(col("background_fees"), F.lit(0).cast(MONEY))).alias("background"),
    )
    return _grouped_side(r, fees, "fees_per_file", folder)


def fact_grain(r: Roles, folder: str | None = None) -> DataFrame:
    """Billed measures per (file, client, billing key, billing date) with the
    file's fee rows attached once: ``fee_rows`` (0 when none), ``misc`` and
    ``background`` sums. Every branch starts from this grain, so the jobs
    write its client days once (``commission_tables``) and scan the line facts once."""
    keys = ["file_key", "client_key", "billing_date_key", "billing_date"]
    return (billed_lines(r, with_fees=True, folder=folder)
            .groupBy(*keys).agg(
                F.sum("amount").alias("amount"),
                F.sum("fee_amount").alias("fee_amount"),
                F.coalesce(F.max("fee_rows"), F.lit(0)).alias("fee_rows"),
                F.max("misc").alias("misc"),
                F.max("background").alias("background")))


def client_day(grain: DataFrame, with_billing_date: bool) -> DataFrame:
    """Measures per (client, billing key[, billing date]) after the per-file
    fee join.

    The source groups lines per file first and left-joins the file fees to
    each such row, so a file's fees count once per file row and the line
    amounts repeat once per fee row (x max(fee rows, 1)). Branches 1-2 group
    files by billing key only, branch 3 also by billing date, so the per-file
    rows are regrouped accordingly before the fee maths.
    """
    keys = ["client_key", "billing_date_key"] + (["billing_date"] if with_billing_date else [])
    per_file = grain
    if not with_billing_date:
        per_file = grain.groupBy("file_key", *keys).agg(
            F.sum("amount").alias("amount"), F.sum("fee_amount").alias("fee_amount"),
            F.max("fee_rows").alias("fee_rows"), F.max("misc").alias("misc"),
            F.max("background").alias("background"))
    copies = F.greatest(col("fee_rows"), F.lit(1)).cast("decimal(10,0)")
    zero = F.lit(0).cast(MONEY)
    return per_file.groupBy(*keys).agg(
        F.sum(col("amount") * copies).alias("actual"),
        F.sum(col("fee_amount") * copies).alias("fees"),
        F.sum(F.coalesce(col("misc"), zero)).alias("misc"),
        F.sum(F.coalesce(col("background"), zero)).alias("background"),
    )


def client_dates(grain: DataFrame) -> DataFrame:
    """Both forms of ``client_day`` in one table, per (client, billing key, billing
    date): the sums with the billing date, and the file fees counted once for each
    file's billing key (``misc_once``, ``background_once``), at its first date.
    Grain rows come partitioned by file, so nothing but these sums is shuffled."""
    zero = F.lit(0).cast(MONEY)
    copies = F.greatest(col("fee_rows"), F.lit(1)).cast("decimal(10,0)")
    misc, background = F.coalesce(col("misc"), zero), F.coalesce(col("background"), zero)
    first = Window.partitionBy("file_key", "client_key", "billing_date_key").orderBy("billing_date")
    once = F.row_number().over(first) == 1
    rows = grain.select(
        "client_key", "billing_date_key", "billing_date", (col("amount") * copies).alias("actual"),
        (col("fee_amount") * copies).alias("fees"), misc.alias("misc"), background.alias("background"),
        F.when(once, misc).alias("misc_once"), F.when(once, background).alias("background_once"))
    sums = ["actual", "fees", "misc", "background", "misc_once", "background_once"]
    return rows.groupBy("client_key", "billing_date_key", "billing_date").agg(*[F.sum(c).alias(c) for c in sums])


def by_client_day(dates: DataFrame) -> DataFrame:
    """``client_day`` without the billing date, from ``client_dates``."""
    return dates.groupBy("client_key", "billing_date_key").agg(
        F.sum("actual").alias("actual"), F.sum("fees").alias("fees"),
        F.sum("misc_once").alias("misc"), F.sum("background_once").alias("background"))


def staged(r: Roles, df: DataFrame, name: str) -> DataFrame:
    """A query's large groupings and joins, written to a folder of their own with
    shuffles sized by the input; what the query adds to them is a projection."""
    return stage_table(df, os.path.join(run_folder(r.spark, name), name))


def client_days(r: Roles, with_billing_date: bool) -> DataFrame:
    """``client_day`` of the whole fact grain, written once."""
    return staged(r, client_day(fact_grain(r), with_billing_date), "client_days")


def adjustments_by(r: Roles, key: str, folder: str | None = None) -> DataFrame:
    """Invoice adjustments pre-aggregated per (``key``, month, year). The months of
    a client hold few rows each, those of an executive many: only the latter are
    grouped where they are read."""
    zero = F.lit(0).cast(MONEY)
    rows = r.invoice_adjustment.select(key, "adjustment_month", "adjustment_year", "adjustment_amount", "bad_debt_amount")
    if key == "client_key":
        rows = spread_rows(rows)
    sums = rows.groupBy(key, "adjustment_month", "adjustment_year").agg(
        F.count(F.lit(1)).alias("adj_rows"),
        F.sum(F.coalesce(col("adjustment_amount"), zero)).alias("adj_sum"),
        F.sum(F.coalesce(col("bad_debt_amount"), zero)).alias("bad_sum"),
    )
    return _grouped_side(r, sums, "adjustments", folder)


def _join_adjustments(l2: DataFrame, adj: DataFrame, key: str) -> DataFrame:
    """L2 rows LEFT JOIN adjustments on key + month/year of the billing key."""
    a = adj.withColumnRenamed(key, "__adj_key")
    cond = ((l2[key] == a["__adj_key"])
            & (key_month(l2["billing_date_key"]) == a["adjustment_month"])
            & (key_year(l2["billing_date_key"]) == a["adjustment_year"]))
    return l2.join(a, cond, "left").drop("__adj_key", "adjustment_month", "adjustment_year")


def _report_measures(rate: Column) -> list[Column]:
    """Select list shared by the three branches, over L3 sums."""
    base = col("actual") - col("fees") - col("misc") - col("background")
    return [
        col("actual").cast(MONEY).alias("actual_amount"),
        col("fees").cast(MONEY).alias("fees_amount"),
        col("misc").cast(MONEY).alias("miscellaneous_fee"),
        col("bad").cast(MONEY).alias("bad_debt_amount"),
        F.round(base, 2).cast("double").alias("commissionable_amount"),
        percent_text(rate).alias("amount_payable_percentage"),
        pay_amount(base - col("adj") - col("bad"), rate).alias("commission_to_be_paid"),
        col("adj").cast(MONEY).alias("adjustment_amount"),
    ]


def _l3_sums(weight: Column, adj_weight: Column | None = None) -> list[Column]:
    """Sums over L2 rows joined to adjustments: an L2 row repeats once per
    matching adjustment row (``weight``), each adjustment counts once per L2
    row (times ``adj_weight`` when one L2 row stands for several)."""
    zero = F.lit(0).cast(MONEY)
    aw = F.lit(1) if adj_weight is None else adj_weight

    def z(c: str) -> Column:
        return F.coalesce(col(c), zero)

    return [
        F.sum(z("actual") * weight).alias("actual"),
        F.sum(z("fees") * weight).alias("fees"),
        F.sum(z("misc") * weight).alias("misc"),
        F.sum(z("background") * weight).alias("background"),
        F.sum(z("adj_sum") * aw).alias("adj"),
        F.sum(z("bad_sum") * aw).alias("bad"),
    ]


# ---------------------------------------------------------------------------
# branches 1 and 2: commission-band card
# ---------------------------------------------------------------------------

_L2_KEYS = ["company_name1", "client_key", "commission_percent", "account_executive",
            "billing_date_key", "account_executive_id", "business_start_date", "site_number"]
_BANDS = ["commission_key", "account_age_min", "account_age_max", "account_pay_percent"]


# L2 columns of a band that has no billings (outer side of the band join)
_L2_NULLS = [
    ("company_name1", "string"), ("client_key", "bigint"), ("commission_percent", PERCENT),
    ("account_executive", "string"), ("billing_date_key", "int"),
    ("account_executive_id", "int"), ("business_start_date", "date"),
    ("site_number", "string"), ("actual", "decimal(38,4)"), ("fees", "decimal(38,4)"),
    ("misc", "decimal(38,2)"), ("background", "decimal(38,2)")]


SPECIAL, REGULAR = 1, 2


def _band_clients(r: Roles, cfg: CommissionConfig, branches) -> DataFrame:
    """Clients of the chosen band branches, tagged: special clients (any start
    date) are branch 1, regular clients started by the cut-off branch 2.

    One row per branch and different grouping columns with its number of
    client rows: repeated client rows repeat line amounts, but the source's
    per-file grouping folds them before file fees are attached. The client's
    percent is a grouping column of branch 1 only."""
    spc = ci_eq("commission_type", "spc")
    reg = ci_eq("commission_type", "REG") & (F.to_date("business_start_date") <= F.lit(cfg.regular_until))
    keep = None
    if SPECIAL in branches:
        keep = spc
    if REGULAR in branches:
        keep = reg if keep is None else keep | reg
    return (r.client.where(keep).withColumn("branch", F.when(spc, SPECIAL).otherwise(REGULAR))
            .withColumn("commission_percent", F.when(spc, col("commission_percent")))
            .groupBy("branch", *[c for c in _L2_KEYS if c != "billing_date_key"])
            .agg(F.count(F.lit(1)).cast("decimal(10,0)").alias("client_rows")))


def band_l2(r: Roles, cfg: CommissionConfig = CommissionConfig(), cd: DataFrame | None = None,
            branches=(SPECIAL, REGULAR), folder: str | None = None) -> DataFrame:
    """L2 of branches 1-2, tagged by branch: client-day measures per band key,
    with every band row of that key, plus one empty row for every band without
    any (the band dimension is the outer side of the source's LEFT JOIN,
    deleted bands included).

    A group is one client day under one band key, so its rows repeat the same
    file fees (``max``) while line amounts count once per client and band row.
    The groups are written once: the bands without any are found from that
    table, not by running the joins again.
    """
    cd = client_day(fact_grain(r), with_billing_date=False) if cd is None else cd
    x = cd.join(_band_clients(r, cfg, branches), "client_key").withColumn(
        "age", days_between(col("business_start_date"), int_key_to_date(col("billing_date_key"))))
    bands = r.commission_band
    xb = range_join(x, bands.select("commission_key", "account_age_min", "account_age_max", "is_delete"),
                    "age", "account_age_min", "account_age_max")
    # the regular branch excludes deleted bands inside its join
    xb = xb.where((col("branch") == SPECIAL) | (col("is_delete") == 0))
    l2 = xb.groupBy("branch", "commission_key", *_L2_KEYS).agg(
        F.sum(col("actual") * col("client_rows")).alias("actual"),
        F.sum(col("fees") * col("client_rows")).alias("fees"),
        F.max("misc").alias("misc"), F.max("background").alias("background"))
    folder = run_folder(r.spark, "band_l2") if folder is None else folder
    l2 = stage_table(l2, os.path.join(folder, "band_l2"))
    # Written as inner rows + (bands anti matched keys) so the big side is
    # never shuffled on a handful of band keys to keep the empty bands.
    matched = l2.select("branch", "commission_key").distinct()
    per_branch = bands.select(*_BANDS, F.explode(F.array(*[F.lit(b) for b in branches])).alias("branch"))
    outer_rows = anti_on(per_branch, matched, ["branch", "commission_key"]).select(
        "branch", *_BANDS, *[F.lit(None).cast(t).alias(c) for c, t in _L2_NULLS])
    return l2.join(bands.select(*_BANDS), "commission_key").unionByName(outer_rows)


def band_l3(r: Roles, l2: DataFrame, folder: str | None = None) -> DataFrame:
    """L3 of branches 1-2: L2 rows with executive-month adjustments attached
    (as weights), grouped to report rows; returns the raw sums. The rate is
    the client's percent (branch 1) or the band's pay percent (branch 2)."""
    l2a = _join_adjustments(l2, adjustments_by(r, "account_executive_id", folder), "account_executive_id")
    weight = F.coalesce(col("adj_rows"), F.lit(1)).cast("decimal(10,0)")
    percent = F.when(col("branch") == SPECIAL, special_percent()).otherwise(regular_percent())
    return (l2a.select("*", percent.alias("rate_key"),
                       band_label(col("account_age_min"), col("account_age_max")).alias("label"),
                       F.trim(col("account_executive")).alias("exec_trim"))
            .groupBy("branch", "rate_key", "company_name1", "client_key", "exec_trim",
                     "billing_date_key", "label", "business_start_date", "site_number")
            .agg(*_l3_sums(weight)))


def band_branches(r: Roles, cfg: CommissionConfig = CommissionConfig(),
                  cd: DataFrame | None = None, branches=(SPECIAL, REGULAR),
                  folder: str | None = None) -> DataFrame:
    """Branches 1 and 2 in one pass (a client is special or regular, never
    both): one client join, one band join, one adjustment join and one
    grouping per level for both, keyed by the branch tag."""
    l3 = band_l3(r, band_l2(r, cfg, cd, branches, folder), folder)
    return to_contract(l3.select(
        col("label").alias("account_aging_in_days"), "client_key",
        col("company_name1").alias("company_name"), "site_number",
        *_report_measures(col("rate_key")),
        F.when(col("branch") == SPECIAL, F.lit("Special")).otherwise(F.lit("Regular"))
         .alias("commission_type"),
        col("exec_trim").alias("account_executive"), "billing_date_key",
        "business_start_date"))


def special_clients(r: Roles) -> DataFrame:
    return r.client.where(ci_eq("commission_type", "spc"))


def regular_percent() -> Column:
    """``ISNULL(AccountPayPercent, 0.00)`` of the band."""
    return isnull_typed(col("account_pay_percent"), 0, PERCENT)


def special_percent() -> Column:
    """``ISNULL(CommissionPercent, 0.00)`` of the client."""
    return isnull_typed(col("commission_percent"), 0, PERCENT)


def commission_special(r: Roles, cfg: CommissionConfig = CommissionConfig(),
                       cd: DataFrame | None = None) -> DataFrame:
    """Branch 1: special clients, rate = the client's own percent; every band
    (deleted ones too) is a candidate."""
    return staged(r, band_branches(r, cfg, cd, (SPECIAL,)), "commission_special")


def commission_regular(r: Roles, cfg: CommissionConfig = CommissionConfig(),
                       cd: DataFrame | None = None) -> DataFrame:
    """Branch 2: regular clients started up to the cut-off, rate = the band's
    pay percent, deleted bands excluded inside the join only."""
    return staged(r, band_branches(r, cfg, cd, (REGULAR,)), "commission_regular")


# ---------------------------------------------------------------------------
# branch 3: new-business buckets
# ---------------------------------------------------------------------------

_RATES = ["yr1_rate", "yr2_rate", "yr3_rate", "perpetual_rate"]


_BUCKET_CLIENT = ["client_key", "company_name1", "account_executive", "account_executive_id",
                  "business_start_date", "site_number"]


def bucket_rates(r: Roles) -> DataFrame:
    """Site buckets per (site, name, raw rates) with the number of bucket
    rows (``bucket_rows``) and of distinct months (``bucket_months``). Sites
    and names are compared under the collation; a name is shown by its
    smallest spelling.

    The source joins buckets on the site only and carries the month through
    two groupings, so each bucket row repeats the amounts and each distinct
    month is its own row when file fees and adjustments are attached.
    """
    keys = ["site_key", "name_key", *_RATES]
    return (r.site_bucket.withColumn("site_key", ci_norm("site_number"))
            .withColumn("name_key", ci_norm("bucket_name"))
            .groupBy(*keys, "bucket_month").agg(F.count(F.lit(1)).alias("c"), F.min("bucket_name").alias("n"))
            .groupBy(*keys).agg(F.sum("c").alias("bucket_rows"), F.count(F.lit(1)).alias("bucket_months"),
                                F.min("n").alias("bucket_name")).drop("name_key"))


def commission_bucket(r: Roles, cfg: CommissionConfig = CommissionConfig(),
                      cd: DataFrame | None = None, folder: str | None = None) -> DataFrame:
    """Branch 3: clients started from the new-business date, any type; rate
    by client age from the site's bucket card.

    Repeated client, band or bucket rows repeat the line amounts; file fees
    are attached after the source has grouped by (file, client, band label,
    bucket, month), so they count once per bucket month.
    """
    cd = client_day(fact_grain(r), with_billing_date=True) if cd is None else cd
    clients = (r.client.where(F.to_date("business_start_date") >= F.lit(cfg.bucket_from))
               .groupBy(*_BUCKET_CLIENT).agg(F.count(F.lit(1)).alias("client_rows")))
    bands = r.new_business_band.groupBy("start_range", "end_range").agg(F.count(F.lit(1)).alias("band_rows"))
    x = cd.join(clients, "client_key")
    x = x.join(bucket_rates(r), ci_norm("site_number") == col("site_key")).drop("site_key")
    x = (x.withColumn("age_key", days_between(col("business_start_date"),
                                              int_key_to_date(col("billing_date_key"))))
         .withColumn("age_day", days_between(col("business_start_date"), col("billing_date"))))
    xb = range_join(x, bands, "age_key", "start_range", "end_range")
    xb = (xb.withColumn("label", band_label(col("start_range"), col("end_range")))
          .withColumn("curr_rate", tier_rate(col("age_day"), *[col(c) for c in _RATES])))
    l2_keys = ["company_name1", "bucket_name", "site_number", "client_key", "curr_rate",
               "account_executive", "account_executive_id", "billing_date_key", *_RATES,
               "business_start_date", "label", "bucket_months"]
    n = (col("client_rows") * col("band_rows") * col("bucket_rows")).cast("decimal(18,0)")
    m = col("bucket_months").cast("decimal(10,0)")
    l2 = xb.groupBy(*l2_keys).agg(
        F.sum(col("actual") * n).alias("actual"), F.sum(col("fees") * n).alias("fees"),
        F.sum(col("misc") * m).alias("misc"), F.sum(col("background") * m).alias("background"))
    # L2 outputs ISNULL(rate, 0) while it grouped on the raw rate
    for c in _RATES:
        l2 = l2.withColumn(c, isnull_typed(col(c), 0, RATE))
    l2a = _join_adjustments(l2, adjustments_by(r, "client_key", folder), "client_key")
    weight = F.coalesce(col("adj_rows"), F.lit(1)).cast("decimal(10,0)")
    months = col("bucket_months").cast("decimal(10,0)")
    l3 = (l2a.withColumn("rate_key", isnull_typed(col("curr_rate"), 0, RATE))
          .withColumn("exec_trim", F.trim(col("account_executive")))
          .groupBy("label", "rate_key", "company_name1", "client_key", "exec_trim",
                   "billing_date_key", "bucket_name", "site_number", "business_start_date",
                   "curr_rate", *_RATES)
          .agg(*_l3_sums(weight, months)))
    return to_contract(l3.select(
        col("label").alias("account_aging_in_days"), "client_key",
        col("company_name1").alias("company_name"), "site_number",
        *_report_measures(col("rate_key")),
        col("bucket_name").alias("commission_type"),
        col("exec_trim").alias("account_executive"), "billing_date_key",
        "business_start_date", *_RATES))


# ---------------------------------------------------------------------------
# staging, load, adjustment-only rows, audit
# ---------------------------------------------------------------------------

def commission_staged(r: Roles, cfg: CommissionConfig = CommissionConfig(),
                      dates: DataFrame | None = None, folder: str | None = None) -> DataFrame:
    """The staging table: the three branches unioned by name, all computed
    from one table of client days; branches 1 and 2 run as one tagged pass."""
    if dates is None:
        dates = staged(r, client_dates(fact_grain(r, folder)), "client_dates")
    by_date = dates.drop("misc_once", "background_once")
    return (band_branches(r, cfg, by_client_day(dates), folder=folder)
            .unionByName(commission_bucket(r, cfg, by_date, folder)))


def commission_tables(r: Roles, cfg: CommissionConfig = CommissionConfig(),
                      folder: str | None = None) -> DataFrame:
    """Run the staging part of the procedure: write the client days and the
    staging table once under the shared checkpoint folder and return a scan
    of the staging table (read by the load, the anti-join and the audit)."""
    folder = run_folder(r.spark, "commission") if folder is None else folder
    dates = stage_table(client_dates(fact_grain(r, folder)), os.path.join(folder, "client_dates"))
    return stage_table(commission_staged(r, cfg, dates, folder), os.path.join(folder, "staged"))


def commission_load(staged: DataFrame, cfg: CommissionConfig = CommissionConfig()) -> DataFrame:
    """Rows loaded from staging: band labels published with separators and
    the package key stamped."""
    return to_contract(
        staged.withColumn("account_aging_in_days", relabel_band(col("account_aging_in_days")))
              .withColumn("audit_inserted_package_key", F.lit(cfg.package_key)),
        MART, enforce=False)


def commission_adjustment_only(r: Roles, staged: DataFrame,
                               cfg: CommissionConfig = CommissionConfig()) -> DataFrame:
    """Invoice adjustments of a client-month that has no report row.

    The band match uses the client's age on the first of the adjustment
    month (deleted bands included); the anti-join runs against the loaded
    rows, which are the staged rows (keys are not relabelled).
    """
    fi = r.invoice_adjustment
    dc = r.client
    have = staged.select(
        col("client_key").alias("h_client"),
        key_month(col("billing_date_key")).alias("h_month"),
        key_year(col("billing_date_key")).alias("h_year")).distinct()
    # the anti-join first: only what it leaves is joined to clients and bands
    x = anti_on(fi, have, (fi["client_key"] == have["h_client"])
                & (fi["adjustment_month"] == have["h_month"])
                & (fi["adjustment_year"] == have["h_year"]))
    x = x.join(dc.drop("account_executive_id"), "client_key")
    x = (x.withColumn("adj_date", first_of_month(col("adjustment_year"), col("adjustment_month")))
         .withColumn("age", days_between(col("business_start_date"), col("adj_date"))))
    x = range_join(x, r.commission_band, "age", "account_age_min", "account_age_max")
    is_reg = ci_eq("commission_type", "REG")
    is_spc = ci_eq("commission_type", "spc")
    rate = F.when(is_reg, col("account_pay_percent")).when(is_spc, col("commission_percent"))
    zero = F.lit(0).cast(MONEY)
    bad = F.coalesce(col("bad_debt_amount"), zero)
    amt = F.coalesce(col("amount"), zero)
    fee = F.coalesce(col("fee"), zero)
    return to_contract(x.select(
        col("company_name1").alias("company_name"), "site_number", "client_key",
        F.lit(None).alias("actual_amount"), F.lit(None).alias("fees_amount"),
        F.lit(None).alias("miscellaneous_fee"),
        "bad_debt_amount",
        (amt - fee - bad).alias("adjustment_amount"),
        (-(bad + (amt - fee))).alias("commissionable_amount"),
        percent_text(rate).alias("amount_payable_percentage"),
        pay_amount(-(bad + amt - fee), isnull_typed(rate, 0, PERCENT)).alias("commission_to_be_paid"),
        F.when(is_reg, F.lit("REGULAR")).when(is_spc, F.lit("Special")).alias("commission_type"),
        "account_executive",
        date_to_key(col("adj_date")).alias("billing_date_key"),
        F.when(is_reg, band_label(col("account_age_min"), col("account_age_max")))
         .alias("account_aging_in_days"),
        "business_start_date",
        F.lit(cfg.package_key).alias("audit_inserted_package_key"),
    ), MART)


def commission_mart(r: Roles, cfg: CommissionConfig = CommissionConfig(),
                    staged: DataFrame | None = None) -> DataFrame:
    """Full report table: loaded rows plus adjustment-only rows."""
    staged = commission_staged(r, cfg) if staged is None else staged
    return commission_load(staged, cfg).unionByName(commission_adjustment_only(r, staged, cfg))


AUDIT_COLUMNS = ["sourcecount", "insertcount", "updatecount", "deletecount",
                 "destinationrowcount", "destinationfinalrowcount", "nochangerowcount",
                 "extractrowcount", "duplicaterecordsfr"]


def inserted_on(day: dt.date) -> Column:
    return F.to_date(col("audit_inserted_date")) == F.lit(day)


def load_audit(loaded: DataFrame, run_date: dt.date) -> DataFrame:
    """The audit result set, one row, from one aggregate pass over the
    loaded table tagged with its origin (no cross join of counts).

    ``loaded`` must carry ``_staged`` (1 for rows from staging) and
    ``audit_inserted_date``; rows of another day than ``run_date`` do not count
    as inserted. update/delete/destination counts are never assigned by the
    source, so they (and ``nochangerowcount``, which adds them) stay NULL.
    """
    null_int = F.lit(None).cast("int")
    agg = loaded.agg(
        F.sum(col("_staged")).cast("bigint").alias("sourcecount"),
        F.count_if(inserted_on(run_date)).cast("bigint").alias("insertcount"),
        F.count(F.lit(1)).cast("bigint").alias("destinationfinalrowcount"),
    )
    return agg.select(
        col("sourcecount"), col("insertcount"),
        null_int.alias("updatecount"), null_int.alias("deletecount"),
        null_int.alias("destinationrowcount"), col("destinationfinalrowcount"),
        F.when(null_int == 0, F.lit(0).cast("bigint"))
         .otherwise(col("sourcecount") - (null_int + null_int)).alias("nochangerowcount"),
        col("sourcecount").alias("extractrowcount"),
        null_int.alias("duplicaterecordsfr"),
    )


def mart_with_audit_tags(r: Roles, cfg: CommissionConfig = CommissionConfig(),
                         staged: DataFrame | None = None) -> DataFrame:
    """Mart rows plus ``_staged`` origin flag and the load timestamp."""
    staged = commission_staged(r, cfg) if staged is None else staged
    ts = ts_lit(cfg.started().run_ts)
    return (commission_load(staged, cfg).withColumn("_staged", F.lit(1))
            .unionByName(commission_adjustment_only(r, staged, cfg).withColumn("_staged", F.lit(0)))
            .withColumn("audit_inserted_date", ts))
