"""``name -> DuckDB SQL`` for every registered query that has an oracle."""

from __future__ import annotations

from ledgerline.plans import fixture as f
from ledgerline.sources.sinks import REPORT_DATASET_HEADINGS

from oracle import operator_sql, warehouse
from oracle import products as p


def oracle_sql() -> dict[str, str]:
    cfg = f.COMMISSION
    out = {
        "commission_special": p.sql_branch("special", cfg),
        "commission_regular": p.sql_branch("regular", cfg),
        "commission_bucket": p.sql_branch("bucket", cfg),
        "staged_union": p.sql_staged(cfg),
        "commission_load": p.sql_load(cfg),
        "commission_adjustment_only": p.sql_adjustment_only(cfg),
        "commission_mart": p.sql_mart(cfg),
        "load_audit": p.sql_audit(cfg),
        "load_audit_dates": p.sql_audit(cfg, "client_key is null or client_key % 2 = 0"),
        "file_component_extract": p.sql_extract_a(f.EXTRACT),
        "file_component_extract_country": p.sql_extract_b(f.COUNTRY_EXTRACT),
        "file_adjudication_report": p.sql_adjudication(f.REPORT),
        "report_headings": p.sql_headings(f.REPORT, REPORT_DATASET_HEADINGS),
        "param_industry": p.sql_param_industry(),
        "param_client_group": p.sql_param_client_group(f.PARAMS),
        "param_filters": p.sql_param_client_group(f.PARAM_HEADERS),
        "param_corp": p.sql_param_corp(f.PARAMS),
        "param_site": p.sql_param_site(f.PARAMS),
        "source_violations": warehouse.sql_violations(),
        "warehouse_mart": p.sql_mart(cfg),
        "warehouse_extract": p.sql_extract_a(f.EXTRACT),
        "report_site_relation": warehouse.sql_site_relation(f.REPORT),
        "param_group_relation": warehouse.SQL_GROUP_RELATION,
        "special_variants": p.sql_branch("special", cfg, True),
        "regular_variants": p.sql_branch("regular", cfg, True),
        "bucket_variants": p.sql_branch("bucket", cfg, True),
        "extract_variants": p.sql_extract_a(f.EXTRACT, True),
        "extract_country_variants": p.sql_extract_b(f.COUNTRY_EXTRACT, True),
        "any_code_variants": operator_sql.any_code(True),
        "group_by_variants": operator_sql.group_by_expression(True),
        "param_industry_variants": p.sql_param_industry(True),
        "param_client_group_variants": p.sql_param_client_group(f.PARAMS, True),
        "param_corp_variants": p.sql_param_corp(f.PARAMS, True),
        "param_site_variants": p.sql_param_site(f.PARAMS, True),
    }
    out.update(operator_sql.ORACLE)
    return out
