"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables through the role views, over whole
tables; parameters are the report parameters, not cost caps. The ``*_variants``
queries run on ``VariantRoles``: the same tables with repeated dimension rows
and texts that differ in case or trailing blanks.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.semantics import ts_lit
from ledgerline.plans import adjudication, commission, extract, fixture, operator_queries, params
from ledgerline.plans.config import ParamSelection
from ledgerline.session import partitions_for
from ledgerline.sources import warehouse
from ledgerline.sources.roles import Roles, VariantRoles
from ledgerline.sources.sinks import REPORT_DATASET_HEADINGS, run_folder, with_display_names

Query = Callable[[SparkSession, str], DataFrame]
CFG = fixture.COMMISSION


def _on(roles, fn) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(roles(spark, sf_dir))
    q.__name__ = getattr(fn, "__name__", "query")
    q.__doc__ = fn.__doc__
    return q


def _roles(fn) -> Query:
    return _on(Roles, fn)


def _variants(fn) -> Query:
    return _on(VariantRoles, fn)


def _load(r: Roles) -> DataFrame:
    return commission.commission_load(commission.commission_tables(r, CFG), CFG)


def _bucket(r: Roles) -> DataFrame:
    return commission.staged(r, commission.commission_bucket(r, CFG), "commission_bucket")


def _adj_only(r: Roles) -> DataFrame:
    only = commission.commission_adjustment_only(r, commission.commission_tables(r, CFG), CFG)
    return commission.staged(r, only, "adjustment_only")


def _mart(r: Roles) -> DataFrame:
    return commission.commission_mart(r, CFG, staged=commission.commission_tables(r, CFG))


def _audit(r: Roles) -> DataFrame:
    staged = commission.commission_tables(r, CFG)
    return commission.load_audit(commission.mart_with_audit_tags(r, CFG, staged=staged), CFG.run_ts.date())


def _audit_dates(r: Roles) -> DataFrame:
    """A10: the audit row where the rows of odd clients were loaded a day
    earlier, so that only the others count as inserted."""
    staged = commission.commission_tables(r, CFG)
    loaded = commission.mart_with_audit_tags(r, CFG, staged=staged)
    before = ts_lit(CFG.run_ts - dt.timedelta(days=1))
    return commission.load_audit(
        loaded.withColumn("audit_inserted_date", F.when(F.col("client_key") % 2 == 1, before)
                          .otherwise(F.col("audit_inserted_date"))), CFG.run_ts.date())


def _headings(r: Roles) -> DataFrame:
    """The report dataset under its display headings."""
    return with_display_names(adjudication.file_adjudication_report(r, fixture.REPORT), REPORT_DATASET_HEADINGS)


COMMISSION_TABLES = ("usage_type", "commission_band", "new_business_band", "file", "component", "client", "billed_line",
                     "file_fees", "invoice_adjustment", "site_bucket")
EXTRACT_TABLES = ("request", "request_detail", "detail_international")


def _loaded(r: Roles, names: tuple[str, ...]) -> warehouse.Warehouse:
    """The tables laid out by ``warehouse.load``, one bucket for each shuffle partition that the largest asks for."""
    buckets = max(partitions_for(getattr(r, n)) for n in names)
    return warehouse.load(r, run_folder(r.spark, "warehouse"), names, buckets)


def _warehouse_mart(r: Roles) -> DataFrame:
    """The report table from laid-out warehouse tables."""
    return _mart(_loaded(r, COMMISSION_TABLES))


def _warehouse_extract(r: Roles) -> DataFrame:
    """The extract from laid-out warehouse tables, its text filters on key columns."""
    return extract.file_component_extract(_loaded(r, EXTRACT_TABLES), fixture.EXTRACT)


def _site_relation(r: Roles) -> DataFrame:
    """Report files whose sites are listed by a relation, the sites with a second bucket month."""
    sites = r.site_bucket.where(F.col("bucket_month") == 2).select("site_number")
    cfg = dataclasses.replace(fixture.REPORT, sites=sites, batches=None)
    return adjudication.report_files(r, cfg).select("file_no", "site_no", "date_completed")


def _group_relation(r: Roles) -> DataFrame:
    """The client-group list for industries that a relation lists, repeats and NULLs included."""
    chosen = r.client_list.where(F.col("active") == 0).select("industry")
    return params.param_client_group(r, ParamSelection(industries=chosen))


PRODUCTS: dict[str, Query] = {
    # D1 executive-commission mart
    "commission_special": _roles(lambda r: commission.commission_special(r, CFG)),
    "commission_regular": _roles(lambda r: commission.commission_regular(r, CFG)),
    "commission_bucket": _roles(_bucket),
    "staged_union": _roles(lambda r: commission.commission_tables(r, CFG)),
    "commission_load": _roles(_load),
    "commission_adjustment_only": _roles(_adj_only),
    "commission_mart": _roles(_mart),
    "load_audit": _roles(_audit),
    "load_audit_dates": _roles(_audit_dates),
    # D2 file-component extracts
    "file_component_extract": _roles(lambda r: extract.file_component_extract(r, fixture.EXTRACT)),
    "file_component_extract_country": _roles(
        lambda r: extract.file_component_extract_country(r, fixture.COUNTRY_EXTRACT)),
    # D3 report dataset
    "file_adjudication_report": _roles(lambda r: adjudication.file_adjudication_report(r, fixture.REPORT)),
    "report_headings": _roles(_headings),
    # D4 parameter lists
    "param_industry": _roles(params.param_industry),
    "param_client_group": _roles(lambda r: params.param_client_group(r, fixture.PARAMS)),
    "param_filters": _roles(lambda r: params.param_client_group(r, fixture.PARAM_HEADERS)),
    "param_corp": _roles(lambda r: params.param_corp(r, fixture.PARAMS)),
    "param_site": _roles(lambda r: params.param_site(r, fixture.PARAMS)),
    # warehouse tables and list relations
    "source_violations": _roles(lambda r: warehouse.source_violations(r, stricter=fixture.STRICT_CONTRACTS)),
    "warehouse_mart": _roles(_warehouse_mart),
    "warehouse_extract": _roles(_warehouse_extract),
    "report_site_relation": _roles(_site_relation),
    "param_group_relation": _roles(_group_relation),
    # repeated dimension rows and collation variants
    "special_variants": _variants(lambda r: commission.commission_special(r, CFG)),
    "regular_variants": _variants(lambda r: commission.commission_regular(r, CFG)),
    "bucket_variants": _variants(_bucket),
    "extract_variants": _variants(lambda r: extract.file_component_extract(r, fixture.EXTRACT)),
    "extract_country_variants": _variants(
        lambda r: extract.file_component_extract_country(r, fixture.COUNTRY_EXTRACT)),
    "any_code_variants": _variants(operator_queries.any_code_join_query),
    "group_by_variants": _variants(operator_queries.group_by_expression),
    "param_industry_variants": _variants(params.param_industry),
    "param_client_group_variants": _variants(lambda r: params.param_client_group(r, fixture.PARAMS)),
    "param_corp_variants": _variants(lambda r: params.param_corp(r, fixture.PARAMS)),
    "param_site_variants": _variants(lambda r: params.param_site(r, fixture.PARAMS)),
}


def queries() -> dict[str, Query]:
    out = dict(PRODUCTS)
    out.update(operator_queries.OPERATOR_QUERIES)
    return out
