"""DuckDB text of the role views (FIXTURES.md), shared by every oracle query,
written independently of the Spark code over the driver's views.
``VARIANTS`` are those that ``VariantRoles`` changes: each reads the plain view,
under its name with ``plain_`` before it.
"""

ROLE_CTES = {
    "usage_type": """
        select * from (values (1, 'Fee'), (2, 'fixed fee'), (3, 'Package'))
            v(usage_type_key, usage_type_name)""",
    "commission_band": """
        select cast(k as integer) as commission_key, cast(lo as integer) as account_age_min,
               cast(hi as integer) as account_age_max,
               cast(p as decimal(5,2)) as account_pay_percent, cast(d as integer) as is_delete
        from (values (1, 0, 365, 10.00, 0), (2, 366, 730, 7.50, 0), (3, 731, 1095, 5.00, 0),
                     (4, 1096, 1461, 2.50, 0), (5, 1462, 9999, 1.00, 0), (6, 0, 30, 99.00, 1),
                     (7, 10000, 12000, null, 0)) v(k, lo, hi, p, d)""",
    "new_business_band": """
        select cast(a as integer) as start_range, cast(b as integer) as end_range
        from (values (0, 365), (366, 730), (731, 1095), (1096, 1461), (1462, 9999)) v(a, b)""",
    "file_dim": """
        select o_orderkey as file_key,
               case when o_orderstatus = 'P' and o_orderkey % 10 = 0 then 1 else 0 end as is_delete
        from orders""",
    "component": """
        select p_partkey as component_key, case when p_size > 45 then 1 else 0 end as charge_as_fee
        from part""",
    "client": """
        select c_custkey as client_key, c_name as company_name1,
               case c_mktsegment when 'BUILDING' then 'REG' when 'MACHINERY' then 'reg '
                    when 'HOUSEHOLD' then 'spc' when 'FURNITURE' then 'SPC' else 'OTH' end
                 as commission_type,
               cast(nullif(c_custkey % 11, 5) as decimal(5,2)) as commission_percent,
               '  Exec ' || cast(c_nationkey as varchar) || ' ' as account_executive,
               c_nationkey as account_executive_id,
               case when c_custkey % 97 = 0 then null
                    else date '1995-01-01' + cast(c_custkey * 7 % 1500 as integer) end
                 as business_start_date,
               'SITE' || lpad(cast(c_nationkey as varchar), 3, '0') || '-0000' as site_number
        from customer""",
    "billed_line": """
        select l_orderkey as file_key, o_custkey as client_key, l_partkey as component_key,
               l_linenumber % 3 + 1 as usage_type_key,
               cast(l_quantity as decimal(18,2)) as quantity,
               cast(l_extendedprice as decimal(18,2)) as unit_price,
               cast(l_shipdate as date) as billing_date,
               cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as integer)
                 as billing_date_key,
               case when l_returnflag = 'R' and l_linestatus = 'F' then 1 else 0 end as is_delete,
               case when l_returnflag = 'A' then 0 else 1 end as is_billed
        from lineitem join orders on l_orderkey = o_orderkey""",
    "file_fees": """
        select o_orderkey as file_key,
               case when o_orderpriority = '5-LOW' then null
                    else cast(o_totalprice as decimal(18,2)) end as miscellaneous_fees,
               cast(o_orderkey % 50 as decimal(18,2)) as background_fees
        from orders where o_orderkey % 4 <> 0""",
    "invoice_adjustment": """
        select o_custkey as client_key, c_nationkey as account_executive_id,
               case when o_orderkey % 500 = 0 then cast(month(o_orderdate) as varchar)
                    else lpad(cast(month(o_orderdate) as varchar), 2, '0') end as adjustment_month,
               cast(year(o_orderdate) as varchar) as adjustment_year,
               cast(o_orderkey % 90 as decimal(18,2)) as adjustment_amount,
               cast(nullif(o_orderkey % 30, 20) as decimal(18,2)) as bad_debt_amount,
               cast(o_orderkey % 70 as decimal(18,2)) as amount,
               cast(nullif(o_orderkey % 40, 10) as decimal(18,2)) as fee
        from orders join customer on o_custkey = c_custkey
        union all
        select user_id, c_nationkey, lpad(cast(month(ts) as varchar), 2, '0'),
               cast(year(ts) as varchar), cast(event_id % 90 as decimal(18,2)),
               cast(value as decimal(18,2)), cast(event_id % 70 as decimal(18,2)),
               cast(null as decimal(18,2))
        from events join customer on user_id = c_custkey
        where event_type = 'purchase'""",
    "site_bucket": """
        select 'SITE' || lpad(cast(n_nationkey as varchar), 3, '0') || '-0000' as site_number,
               m as bucket_month,
               'Bucket ' || cast(n_nationkey % 4 as varchar) as bucket_name,
               cast(10 as decimal(4,2)) as yr1_rate,
               cast(n_nationkey % 9 as decimal(4,2)) as yr2_rate,
               cast(nullif(n_nationkey % 3, 1) as decimal(4,2)) as yr3_rate,
               cast(1 as decimal(4,2)) as perpetual_rate
        from nation cross join (values (1), (2)) w(m)
        where m = 1 or n_nationkey % 5 = 0""",
    "request": """
        select 'AF' || lpad(cast(o_orderkey as varchar), 8, '0') as file_no,
               'Site' || lpad(cast(c_nationkey as varchar), 3, '0') || '-0000' as site_no,
               case when o_orderkey % 6 = 0 then null else o_orderpriority end as batch_no,
               c_mktsegment as first_name, c_name as last_name,
               cast(o_orderdate as date) as date_requested, o_orderdate as date_completed,
               o_orderpriority as requester,
               case o_orderstatus when 'F' then 'CLOSED' when 'O' then 'closed ' else 'PENDING' end
                 as status,
               case when o_orderkey % 3 = 0 then 'none' else 'PKG' || cast(o_orderkey % 3 as varchar) end
                 as package,
               case when o_orderkey % 5 = 0 then 1 when o_orderkey % 5 = 1 then null else 0 end
                 as trouble_flag,
               case cast(o_orderkey % 5 as integer) when 0 then 'view' when 1 then 'signup'
                    when 2 then 'error' when 3 then 'click' else 'purchase' end as client_req_status,
               c_nationkey as account_no
        from orders join customer on o_custkey = c_custkey""",
    "request_detail": """
        select 'AF' || lpad(cast(l_orderkey as varchar), 8, '0') as file_no,
               l_linenumber as line_no,
               cast(l_extendedprice as decimal(18,2)) as unit_price,
               l_shipdate as date_completed,
               case l_returnflag when 'R' then null when 'A' then '  ' else p_type end as report_desc,
               p_brand as report_type,
               case l_linenumber when 1 then 'P' when 2 then 'F1' when 3 then 'f' when 4 then null
                    else 'A' end as type_code,
               case when l_partkey % 10 = 0 then 'NOTREQ' when l_partkey % 10 = 1 then 'SUSPENDED'
                    when l_partkey % 10 = 2 then null else 'DONE' end as status
        from lineitem join part on l_partkey = p_partkey""",
    "detail_international": """
        select 'AF' || lpad(cast(l_orderkey as varchar), 8, '0') as file_no,
               l_linenumber as line_no,
               case when l_orderkey % 7 = 0 then ' ' when l_orderkey % 7 = 1 then null
                    when l_orderkey % 2 = 0 then 'NATION_' || cast(l_orderkey % 30 as varchar)
                    else cast(l_orderkey % 30 as varchar) end as country
        from (select distinct l_orderkey, l_linenumber from lineitem where l_linenumber % 2 = 0) d""",
    "country_code": """
        select n_name as long_code,
               case when n_nationkey % 5 = 0 then n_name when n_nationkey % 7 = 0 then '1'
                    else cast(n_nationkey as varchar) end as short_code,
               case when n_nationkey = 3 then null when n_nationkey = 4 then ' '
                    else 'Country ' || cast(n_nationkey as varchar) end as description
        from nation""",
    "adjudication": """
        select 'AF' || lpad(cast(user_id as varchar), 8, '0') as file_no,
               event_type as req_status,
               case when event_id % 50 = 0 then null else ts end as created_at
        from events""",
    "client_status": """
        select s as req_status, n_nationkey as account_no,
               upper(s) || ' / ' || n_name as description
        from nation cross join (values ('click'), ('error'), ('purchase'), ('signup'), ('view')) e(s)""",
    "billing_note": """
        select 'AF' || lpad(cast(o_orderkey as varchar), 8, '0') as file_no,
               case when o_orderkey % 4 = 0 then 'OTHER' when o_orderkey % 4 = 1 then 'empid'
                    else 'EMPID' end as code,
               'E' || cast(o_custkey as varchar) as note_value
        from orders where o_orderkey % 3 <> 0""",
    "request_extra": """
        select 'AF' || lpad(cast(user_id as varchar), 8, '0') as file_no,
               event_type || cast(event_id as varchar) || '@example.com' as email
        from events""",
    "client_list": """
        select case when c_custkey % 13 = 0 then '' when c_custkey % 13 = 1 then '  '
                    when c_custkey % 13 = 2 then null else c_mktsegment end as industry,
               case when c_custkey % 17 = 0 then 'PSTS' when c_custkey % 17 = 1 then 'test'
                    else 'SITE' end || lpad(cast(c_custkey as varchar), 6, '0') as site_no,
               case when c_custkey % 19 = 0 then 0 else 1 end as active,
               'GR' || lpad(cast(c_nationkey as varchar), 2, '0') || '-' || cast(c_custkey % 3 as varchar)
                 as group_no,
               'CORP' || cast(c_custkey % 40 as varchar) as corp_id,
               case when c_custkey % 23 = 0 then null else c_name end as company_name
        from customer""",
}


VARIANTS = {
    "client": """
        select * replace (if(client_key % 2 = 0, upper(account_executive), account_executive) as account_executive)
        from plain_client
        union all
        select * replace (if(client_key % 2 = 0, upper(account_executive), account_executive) as account_executive)
        from plain_client where client_key % 53 = 0""",
    "commission_band": """
        select * from plain_commission_band
        union all select * from plain_commission_band where commission_key = 2""",
    "new_business_band": """
        select * from plain_new_business_band
        union all select * from plain_new_business_band where start_range = 366""",
    "site_bucket": """
        select * replace (if(yr2_rate >= 4, lower(site_number) || '  ', site_number) as site_number)
        from plain_site_bucket
        union all
        select * replace (if(yr2_rate >= 4, lower(site_number) || '  ', site_number) as site_number,
                          upper(bucket_name) as bucket_name)
        from plain_site_bucket where yr2_rate % 2 = 0""",
    "detail_international": """
        select * from plain_detail_international
        union all
        select * replace (lower(country) || ' ' as country) from plain_detail_international
        where file_no like '%7'""",
    "client_list": """
        select * replace (
            case right(site_no, 1) when '3' then lower(industry) when '4' then industry || ' ' else industry end as industry,
            if(right(site_no, 1) = '5', lower(group_no), group_no) as group_no,
            if(right(site_no, 1) = '6', lower(corp_id) || '  ', corp_id) as corp_id)
        from plain_client_list""",
}


def with_roles(body: str, variants: bool = False) -> str:
    """Prefix ``body`` with the role CTEs it mentions (by name)."""
    import re

    used = [n for n in ROLE_CTES if re.search(rf"\b{n}\b", body)]
    # roles never reference each other, so order is free
    if not used:
        return body
    ctes = []
    for n in used:
        if variants and n in VARIANTS:
            ctes += [f"plain_{n} as ({ROLE_CTES[n]})", f"{n} as ({VARIANTS[n]})"]
        else:
            ctes.append(f"{n} as ({ROLE_CTES[n]})")
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {', '.join(ctes)},\n{body[5:]}"
    return f"with {', '.join(ctes)}\n{body}"
