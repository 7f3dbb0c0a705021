"""File information + adjudication report dataset.

The source computes eight correlated look-ups per report row. Here each
look-up table is aggregated once to one row per correlation key (partial
aggregation before the shuffle) and left-joined to the filtered files, so
nothing is evaluated per row and nothing runs as a nested loop.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.semantics import ci_eq, ci_norm, ci_starts, key_eq, key_in, ts_lit
from ledgerline.operators.aggregates import conditional_sums
from ledgerline.operators.joins import any_row_lookup, check_single, first_rank, single_value_lookup
from ledgerline.plans.config import AdjudicationConfig
from ledgerline.sources.roles import Roles
from ledgerline.sources.sinks import run_folder, stage_table

col = F.col


def _listed(df: DataFrame, name: str, values, strict_null: bool) -> DataFrame:
    if values is None:
        return df.where(F.lit(False)) if strict_null else df
    return key_in(df, name, values)


def report_files(r: Roles, cfg: AdjudicationConfig) -> DataFrame:
    """Files completed after the start and before the day after the end
    (open interval: exactly the start midnight is excluded), site and batch
    in the lists (values or relations), status CLOSED."""
    end_next = ts_lit(cfg.end_date + dt.timedelta(days=1))
    q = r.request
    q = q.where((col("date_completed") > ts_lit(cfg.start_date))
                & (col("date_completed") < end_next)
                & key_eq(q, "status", cfg.status))
    return _listed(_listed(q, "site_no", cfg.sites, cfg.strict_null), "batch_no", cfg.batches, cfg.strict_null)


def _for_files(df: DataFrame, files: DataFrame | None, key: str = "file_no") -> DataFrame:
    """Restrict a look-up table to the report's files before aggregating it,
    so the aggregation scales with the report, not with the whole table."""
    if files is None:
        return df
    return df.join(files.select(col("file_no").alias(key)), key, "left_semi")


def employee_ids(r: Roles, files: DataFrame | None = None) -> DataFrame:
    """Employee id note of the file (code EMPID): at most one per file."""
    notes = _for_files(r.billing_note.where(key_eq(r.billing_note, "code", "EMPID")), files)
    return single_value_lookup(notes, ["file_no"], "note_value", "employee_id")


def applicant_emails(r: Roles, files: DataFrame | None = None) -> DataFrame:
    return any_row_lookup(_for_files(r.request_extra, files), ["file_no"], "email",
                          "applicant_email", "min")


def cost_totals(r: Roles, files: DataFrame | None = None) -> DataFrame:
    """Fee / service / total price per file in one pass (NULL when none)."""
    t = col("type_code")
    sums = conditional_sums(_for_files(r.request_detail, files), ["file_no"], "unit_price", {
        "fee_total": ci_starts(t, "F"),
        "service_total": ~ci_starts(t, "F"),
        "total_file_cost": None,
    })
    # SUM of decimal(p, s) is decimal(38, s) in the source dialect
    return sums.select("file_no", *[col(c).cast("decimal(38,2)").alias(c)
                                    for c in ("fee_total", "service_total", "total_file_cost")])


def status_descriptions(r: Roles) -> DataFrame:
    """One row per (status, account): the smallest description, and the one
    that an ascending NULL-first order puts first."""
    cs = r.client_status.select(ci_norm("req_status").alias("st_key"),
                                col("account_no").alias("st_account"), "description")
    return cs.groupBy("st_key", "st_account").agg(
        F.min("description").alias("flag_description"),
        F.min_by("description", F.struct(col("description").isNotNull(), col("description"))).alias("first_description"),
        F.count(F.lit(1)).alias("st_rows"))


_FILE_KEYS = ["file_no", "client_req_status", "account_no"]


def adjudication_facts(r: Roles, files: DataFrame) -> DataFrame:
    """Both look-ups into the adjudications in one pass, per (file, current
    status, account): ``original_adj``, the description of the earliest one
    (NULL date first) whose status differs from the current one and has a text
    in the file's own account; and ``current_adj_date``, the latest date with the
    current status."""
    f = files.select(*_FILE_KEYS).distinct()
    ad = r.adjudication.select("file_no", ci_norm("req_status").alias("ad_key"), "created_at")
    st = status_descriptions(r).withColumnRenamed("st_account", "account_no")
    x = f.join(ad, "file_no")
    x = x.join(st, (x["ad_key"] == st["st_key"]) & (x["account_no"] == st["account_no"]), "left").drop(st["account_no"])
    now = ci_norm("client_req_status")
    differs = (now != col("ad_key")) & col("st_rows").isNotNull()
    created = col("created_at")
    rank = first_rank(created, col("first_description"), differs)
    return x.groupBy(*_FILE_KEYS).agg(
        F.min_by("first_description", rank).alias("original_adj"),
        F.max(F.when(now == col("ad_key"), created)).alias("current_adj_date"))


def file_adjudication_report(r: Roles, cfg: AdjudicationConfig = AdjudicationConfig(),
                             folder: str | None = None) -> DataFrame:
    """The report rows. The filtered files are written once (under the shared
    checkpoint folder) and read by the main join and every look-up, so the
    request table is scanned once however many look-ups correlate on it. The
    adjudications are read in one pass; the look-ups by file number come
    last, so that they share one partitioning of the report rows."""
    folder = run_folder(r.spark, "report") if folder is None else folder
    files = stage_table(report_files(r, cfg), os.path.join(folder, "files"))
    st = status_descriptions(r).select("st_key", "st_account", "flag_description")
    x = files.join(adjudication_facts(r, files), _FILE_KEYS, "left")
    x = x.join(st, (ci_norm(x["client_req_status"]) == st["st_key"])
               & (x["account_no"] == st["st_account"]), "left")
    x = (x.join(employee_ids(r, files), "file_no", "left")
         .join(applicant_emails(r, files), "file_no", "left")
         .join(cost_totals(r, files), "file_no", "left"))
    temp = x.select(
        col("site_no"), col("batch_no"), col("file_no"), col("first_name"), col("last_name"),
        col("date_requested"), col("date_completed"), col("requester"),
        col("status").alias("file_status"), col("package"), col("trouble_flag"),
        check_single("employee_id", "EMPID per file").alias("employee_id"),
        col("applicant_email"), col("fee_total"), col("service_total"), col("total_file_cost"),
        col("original_adj"), col("flag_description"), col("current_adj_date"),
    ).distinct()
    return temp.select(
        "site_no", "batch_no", "file_no", "first_name", "last_name", "date_requested",
        "date_completed", "requester", "file_status",
        F.when(ci_eq("package", "NONE"), F.lit("A LA CARTE")).otherwise(col("package")).alias("package"),
        "applicant_email", "fee_total", "service_total", "total_file_cost",
        F.when(col("original_adj").isNull(), F.lit(" ")).otherwise(col("original_adj")).alias("original_adj"),
        "flag_description", "current_adj_date",
        F.coalesce(col("employee_id"), F.lit("")).alias("employee_id"),
        F.when(col("trouble_flag") == 1, F.lit("Y")).otherwise(F.lit("N")).alias("troubled_file"),
    )
