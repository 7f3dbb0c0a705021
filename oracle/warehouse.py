"""DuckDB SQL of the queries on source limits and on lists that are relations."""

from __future__ import annotations

import datetime as dt

from ledgerline.plans.config import AdjudicationConfig

from oracle.roles import with_roles

# Table (view) -> columns that must not be NULL, and length limits.
LIMITS = {
    "usage_type": (["usage_type_key"], {"usage_type_name": 50}),
    "commission_band": (["commission_key"], {}),
    "new_business_band": ([], {}),
    "file": (["file_key"], {}),
    "component": (["component_key"], {}),
    "client": (["client_key"], {"company_name1": 255, "commission_type": 55, "account_executive": 61, "site_number": 50}),
    "billed_line": (["file_key", "client_key", "component_key", "billing_date_key"], {}),
    "file_fees": (["file_key"], {}),
    "invoice_adjustment": (["client_key"], {"adjustment_month": 2, "adjustment_year": 4}),
    "site_bucket": (["site_number"], {"site_number": 50, "bucket_name": 55}),
    "request": (["file_no"], {}),
    "request_detail": (["file_no"], {}),
    "detail_international": (["file_no"], {}),
    "country_code": ([], {}),
    "adjudication": (["file_no", "created_at"], {"req_status": 6}),
    "client_status": ([], {}),
    "billing_note": (["file_no"], {}),
    "request_extra": (["file_no"], {}),
    "client_list": (["industry", "site_no", "company_name"], {"industry": 8, "site_no": 10, "company_name": 20}),
}


def sql_violations() -> str:
    rows = []
    for name, (keys, lengths) in LIMITS.items():
        view = {"file": "file_dim"}.get(name, name)
        nulls = " + ".join(["0", *[f"count(*) filter ({k} is null)" for k in keys]])
        longs = " + ".join(["0", *[f"count(*) filter (length({c}) > {n})" for c, n in lengths.items()]])
        rows.append(f"select '{name}' as table_name, count(*) as n_rows, {nulls} as null_violations, {longs} as long_values from {view}")
    return with_roles(" union all ".join(rows))


def sql_site_relation(cfg: AdjudicationConfig) -> str:
    return with_roles(f"""
select file_no, site_no, date_completed from request
where upper(rtrim(status)) = '{cfg.status.upper()}'
  and date_completed > timestamp '{cfg.start_date}' and date_completed < timestamp '{cfg.end_date + dt.timedelta(days=1)}'
  and upper(rtrim(site_no)) in (select upper(rtrim(site_number)) from site_bucket where bucket_month = 2)""")


SQL_GROUP_RELATION = with_roles("""
select min(group_no) as client, min(group_no) as group_key from client_list
where upper(rtrim(industry)) in (select upper(rtrim(industry)) from client_list where active = 0)
group by upper(rtrim(group_no))""")
