"""DuckDB SQL of the operator-level queries, on the grains of ``oracle.products``."""

from __future__ import annotations

import datetime as dt

from ledgerline.plans import operator_queries as oq
from ledgerline.plans import fixture

from oracle import products as p
from oracle.roles import with_roles

CFG = fixture.COMMISSION
same, q, blank = p.same, p.q, p.blank

# per client and day, after file fees: without and with the billing date
CLIENT_DAY = f"""{p.LINES},
file_day as (
  select file_key, client_key, billing_date_key, sum(line_amount) as amount, sum(line_fee) as fee
  from line_fact group by all),
client_day as ({p._fees_attached('file_day')})"""

CLIENT_DATE = f"""{p.LINES},
file_date as (
  select file_key, client_key, billing_date_key, billing_date, sum(line_amount) as amount, sum(line_fee) as fee
  from line_fact group by all),
client_date as ({p._fees_attached('file_date')})"""

_AGE = p.days("who.business_start_date", p.key_date("day.billing_date_key"))
_BANDED = f"""from client_day day join client who using (client_key)
        join commission_band card on {_AGE} between card.account_age_min and card.account_age_max"""
_LABEL = p.span("card.account_age_min", "card.account_age_max")
_OPEN_END = oq.CLOSED_TO + dt.timedelta(days=1)


def any_code(variants: bool = False) -> str:
    return with_roles(f"""
        select abroad.file_no, abroad.line_no, abroad.country, named.long_code, named.description
        from detail_international abroad
        left join country_code named
          on {same('abroad.country')} in ({same('named.long_code')}, {same('named.short_code')})""", variants)


def group_by_expression(variants: bool = False) -> str:
    return with_roles(f"""with {CLIENT_DAY},
    named as (select trim(who.account_executive) as executive, coalesce(who.commission_percent, 0) as percent, day.amount
              from client_day day join client who using (client_key))
    select min(executive) as account_executive, cast(percent as decimal(5,2)) as percent,
           cast(sum(amount) as decimal(38,4)) as actual, count(*) as client_days
    from named group by {same('executive')}, percent""", variants)


ORACLE = {
    "scan_lookup": with_roles(f"select * from request_detail where file_no = {q(oq.LOOKUP_FILE)}"),
    "scan_lookup_international": with_roles(
        f"select * from detail_international where file_no = {q(oq.LOOKUP_FILE)}"),
    "commission_maths": with_roles(f"""with {p.LINES}, {p.branch_ctes('regular', CFG)},
        shown as ({p.report_rows('regular')})
        select client_key, billing_date_key, account_aging_in_days, commissionable_amount,
               amount_payable_percentage, commission_to_be_paid from shown"""),
    "replace_load": p.sql_mart(CFG),
    "ci_filter": with_roles(f"""
        select file_no, line_no, type_code, status, report_type from request_detail
        where {same('status')} not in ('NOTREQ', 'SUSPENDED') and upper(report_type) not like 'BRAND#1%'
          and (upper(type_code) like 'F%' or {same('type_code')} = 'P')"""),
    "blank_fallback": with_roles(f"""
        select line.file_no, line.line_no, if({blank('line.report_desc')}, line.report_type, line.report_desc) as component,
               if({blank('abroad.country')}, 'USA', abroad.country) as country,
               line.report_desc is null as desc_is_null
        from request_detail line left join detail_international abroad using (file_no, line_no)"""),
    "code_labels": with_roles(f"""
        select file_no, if({same('package')} = 'NONE', 'A LA CARTE', package) as package,
               if(trouble_flag = 1, 'Y', 'N') as troubled_file,
               case {same('status')} when 'CLOSED' then 'Closed' when 'PENDING' then 'Open' end as status_label
        from request"""),
    "date_ranges": with_roles(f"""
        select file_no, date_completed,
               date_completed between {q(oq.CLOSED_FROM)} and {q(oq.CLOSED_TO)} as in_closed_range,
               date_completed > {q(oq.CLOSED_FROM)} and date_completed < {q(_OPEN_END)} as in_open_range,
               cast(date_completed as date) <= {q(oq.CUTOFF)} as on_or_before_cutoff
        from request"""),
    "star_join": with_roles(f"""with {p.LINES}
        select file_key, client_key, billing_date_key, billing_date,
               cast(line_amount as decimal(38,4)) as amount, cast(line_fee as decimal(38,4)) as fee_amount
        from line_fact"""),
    "distinct_derived_join": with_roles("""with different_line as (
          select distinct file_no, line_no, line.unit_price, abroad.country
          from request_detail line left join detail_international abroad using (file_no, line_no))
        select file_no, file.first_name, line.line_no, line.unit_price, line.country
        from request file join different_line line using (file_no)"""),
    "left_join_fees": with_roles(f"""with {CLIENT_DAY}
        select client_key, billing_date_key, cast(amount as decimal(38,4)) as actual,
               cast(fee as decimal(38,4)) as fees, cast(misc as decimal(38,2)) as misc,
               cast(background as decimal(38,2)) as background
        from client_day"""),
    "band_outer_join": with_roles(f"""with {p.LINES}, {p.branch_ctes('regular', CFG)}
        select commission_key, day.client_key, day.billing_date_key,
               cast(day.amount as decimal(38,4)) as actual, cast(day.fee as decimal(38,4)) as fees
        from commission_band left join regular_client_day day using (commission_key)"""),
    "month_key_join": with_roles(f"""with {CLIENT_DAY}
        select day.client_key, day.billing_date_key, count(adj.client_key) as adj_rows,
               cast(sum(day.amount) as decimal(38,4)) as actual_total,
               cast(sum(coalesce(adj.adjustment_amount, 0)) as decimal(38,2)) as adjustment_total,
               cast(sum(coalesce(adj.bad_debt_amount, 0)) as decimal(38,2)) as bad_debt_total
        from client_day day
        left join invoice_adjustment adj on adj.client_key = day.client_key
         and adj.adjustment_year || adj.adjustment_month
             = {p.key_year('day.billing_date_key')} || {p.key_month('day.billing_date_key')}
        group by all"""),
    "range_band_join": with_roles(f"""with {CLIENT_DAY}
        select client_key, day.billing_date_key, cast({_AGE} as integer) as age, card.commission_key {_BANDED}"""),
    "band_labels": with_roles(f"""with {CLIENT_DAY}
        select client_key, day.billing_date_key, card.commission_key, {_LABEL} as label,
               {p.published(_LABEL)} as published_label {_BANDED}"""),
    "any_code_join": any_code(),
    "unmatched_adjustments": with_roles(f"""with {p.LINES},
        billed_month as (select distinct client_key, {p.key_year('billing_date_key')} as y, {p.key_month('billing_date_key')} as m
                         from line_fact)
        select adj.client_key, adj.adjustment_month, adj.adjustment_year,
               cast(strftime({p.first_of_month()}, '%Y%m%d') as integer) as billing_date_key,
               cast(coalesce(adj.amount, 0) - coalesce(adj.fee, 0) - coalesce(adj.bad_debt_amount, 0) as decimal(18,2))
                 as adjustment_amount,
               cast(coalesce(adj.fee, 0) - coalesce(adj.amount, 0) - coalesce(adj.bad_debt_amount, 0) as double)
                 as commissionable_amount
        from invoice_adjustment adj
        where not exists (select 1 from billed_month b where b.client_key = adj.client_key
                            and b.y = adj.adjustment_year and b.m = adj.adjustment_month)"""),
    "single_value_lookup": with_roles(f"""with {p.KEYED_REQUEST}, {p.LOOKUPS}
        select file_no, employee_id from keyed_request left join employee using (file_no)"""),
    "any_row_lookup": with_roles(f"""with {p.KEYED_REQUEST}, {p.LOOKUPS}
        select file_no, applicant_email, flag_description, current_adj_date
        from keyed_request {p.WITH_LOOKUPS}"""),
    "first_differing_status": with_roles(f"""with {p.KEYED_REQUEST}, {p.LOOKUPS}
        select file_no, original_adj from keyed_request left join original using (file_no, account_no, status_key)"""),
    "constant_rate_column": with_roles(f"""with fifth as (
          select account_pay_percent from commission_band where commission_key = 5)
        select client_key, company_name1, (select max(account_pay_percent) from fifth) as key5_pay_percent
        from client where {same('commission_type')} = 'SPC'"""),
    "fee_service_totals": with_roles(f"""with {p.KEYED_REQUEST}, {p.LOOKUPS}
        select file_no, fee_total, service_total, total_file_cost
        from keyed_request left join price using (file_no)"""),
    "three_level_rollup": with_roles(f"""with {p.LINES}, {p.branch_ctes('regular', CFG)}
        select rate as rate_key, company_name1, client_key, executive as exec_trim, billing_date_key, label,
               business_start_date, site_number,
               cast(amount as decimal(38,4)) as actual, cast(fee as decimal(38,4)) as fees,
               cast(misc as decimal(38,4)) as misc, cast(background as decimal(38,4)) as background,
               cast(adjusted as decimal(38,4)) as adj, cast(bad_debt as decimal(38,4)) as bad
        from regular_report"""),
    "group_by_expression": group_by_expression(),
    "rate_tiers": with_roles(f"""with {CLIENT_DATE},
        aged as (select client_key, day.billing_date_key, bucket.*,
                        {p.days('who.business_start_date', 'day.billing_date')} as age
                 from client_date day join client who using (client_key)
                 join site_bucket bucket on {same('bucket.site_number')} = {same('who.site_number')})
        select client_key, billing_date_key, bucket_month, cast(age as integer) as age_days,
               case when age between 1 and 365 then yr1_rate when age between 366 and 730 then yr2_rate
                    when age between 731 and 1095 then yr3_rate else perpetual_rate end as curr_rate
        from aged"""),
}
