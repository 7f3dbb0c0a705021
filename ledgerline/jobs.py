"""Batch jobs: what a scheduler runs on the cluster.

    spark-submit -m ledgerline.jobs commission --tables <dir> --target <dir>

Each job reads the role tables, writes its output once as parquet, and
returns a small summary. Intermediate tables live under the cluster's shared
checkpoint folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json
import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans import adjudication, commission, extract, params
from ledgerline.plans.config import (
    COUNTRY_EXTRACT, AdjudicationConfig, CommissionConfig, ExtractConfig, ParamSelection,
)
from ledgerline.session import JOB_CONF
from ledgerline.sources.roles import Roles
from ledgerline.sources.sinks import (
    EXTRACT_HEADINGS, KEEP_VERSIONS, PARAM_HEADINGS, REPORT_DATASET_HEADINGS, drop_folder,
    read_current, replace_load, run_folder, with_display_names,
)
from ledgerline.sources.warehouse import CONTRACTS, Warehouse, load, source_violations


def open_tables(spark: SparkSession, tables: str, source: str = "fixture"):
    """The tables a job reads: ``warehouse``, real tables held to their
    contracts, or ``fixture``, views that are derived from the test tables."""
    return {"warehouse": Warehouse, "fixture": Roles}[source](spark, tables)


def run_load(spark: SparkSession, tables: str, target: str, source: str = "warehouse", buckets: int = 0) -> dict:
    """Lay the tables out for the other jobs; rows by table."""
    laid = load(open_tables(spark, tables, source), target, buckets=buckets)
    return {name: laid.table(name).count() for name in CONTRACTS}


def run_check(spark: SparkSession, tables: str, target: str, source: str = "warehouse") -> dict:
    """What the tables' contracts forbid: written, and summed for the caller."""
    out = source_violations(open_tables(spark, tables, source))
    out.coalesce(1).write.mode("overwrite").parquet(target)
    r = spark.read.schema(out.schema).parquet(target).agg(F.sum("null_violations"), F.sum("long_values")).first()
    return {"null_violations": r[0], "long_values": r[1]}


def run_commission(spark: SparkSession, tables: str, target: str,
                   cfg: CommissionConfig = CommissionConfig(), keep: int = KEEP_VERSIONS,
                   source: str = "fixture") -> dict:
    """Rebuild the executive-commission report table and return the audit row.

    Staging (client days, band groups, staged branches) is written once and
    removed at the end, also after a failure; the report table is replaced in one write (new version +
    pointer, never an empty table); the audit counts are collected by an
    ``Observation`` during that write, so no extra pass over the data is needed.
    """
    r, cfg = open_tables(spark, tables, source), cfg.started()
    folder = run_folder(spark, "commission")
    try:
        staged = commission.commission_tables(r, cfg, folder)
        mart = commission.mart_with_audit_tags(r, cfg, staged=staged)
        obs = Observation("commission_load")
        replace_load(mart, target, obs, (
            F.sum("_staged").alias("staged_rows"),
            F.count_if(commission.inserted_on(cfg.run_ts.date())).alias("inserted_rows")), keep)
        m = obs.get
    finally:
        drop_folder(spark, folder)
    staged_rows = int(m["staged_rows"] or 0)
    return {"sourcecount": staged_rows, "insertcount": int(m["inserted_rows"]), "updatecount": None,
            "deletecount": None, "destinationrowcount": None,
            "destinationfinalrowcount": int(m["rows"]), "nochangerowcount": None,
            "extractrowcount": staged_rows, "duplicaterecordsfr": None}


def _write(df: DataFrame, path: str, headings: dict | None = None) -> int:
    obs = Observation("rows")
    out = with_display_names(df, headings) if headings else df
    out.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return int(obs.get["n"])


def run_extracts(spark: SparkSession, tables: str, out: str, cfg: ExtractConfig = ExtractConfig(),
                 country: ExtractConfig = COUNTRY_EXTRACT, source: str = "fixture") -> dict:
    """Both extracts, each with its own site prefix and dates."""
    r, folder = open_tables(spark, tables, source), run_folder(spark, "extracts")
    try:
        return {
            "file_component_extract": _write(extract.file_component_extract(r, cfg, folder=folder),
                                             os.path.join(out, "file_component_extract"), EXTRACT_HEADINGS),
            "file_component_extract_country": _write(
                extract.file_component_extract_country(r, country),
                os.path.join(out, "file_component_extract_country"), EXTRACT_HEADINGS),
        }
    finally:
        drop_folder(spark, folder)


def run_report_dataset(spark: SparkSession, tables: str, out: str, cfg: AdjudicationConfig = AdjudicationConfig(),
                       sel: ParamSelection = ParamSelection(), source: str = "fixture") -> dict:
    r, folder = open_tables(spark, tables, source), run_folder(spark, "report")
    lists = {"param_industry": params.param_industry(r), "param_client_group": params.param_client_group(r, sel),
             "param_corp": params.param_corp(r, sel), "param_site": params.param_site(r, sel)}
    try:
        res = {"file_adjudication_report": _write(adjudication.file_adjudication_report(r, cfg, folder),
                                                  os.path.join(out, "file_adjudication_report"),
                                                  REPORT_DATASET_HEADINGS)}
    finally:
        drop_folder(spark, folder)
    return res | {name: _write(df, os.path.join(out, name), PARAM_HEADINGS) for name, df in lists.items()}


def _day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def _moment(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def parser() -> argparse.ArgumentParser:
    """Command line of the jobs; every report parameter has an option."""
    ap = argparse.ArgumentParser(prog="ledgerline.jobs")
    ap.add_argument("job", choices=["commission", "extracts", "report", "load", "check"])
    ap.add_argument("--tables", required=True, help="folder with the source tables")
    ap.add_argument("--source", choices=["warehouse", "fixture"], default="warehouse",
                    help="what the folder holds: a table for each name of sources.warehouse.CONTRACTS, or the test tables")
    ap.add_argument("--target", required=True, help="output folder")
    ap.add_argument("--buckets", type=int, default=0,
                    help="load: buckets of the tables joined by file (about one per 128-256 MB); 0: not bucketed")
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="initial shuffle partitions (AQE coalesces them); size it to about "
                         "one per 128-256 MB of the largest shuffle, e.g. 40000 for 10 TB")
    c, e, x, a = CommissionConfig(), ExtractConfig(), COUNTRY_EXTRACT, AdjudicationConfig()
    g = ap.add_argument_group("commission")
    g.add_argument("--package-key", type=int, default=c.package_key)
    g.add_argument("--regular-until", type=_day, default=c.regular_until, help="last start date of the regular card")
    g.add_argument("--bucket-from", type=_day, default=c.bucket_from, help="first start date of the buckets")
    g.add_argument("--run-ts", type=_moment, default=None, help="load timestamp (default: now, UTC)")
    g.add_argument("--keep-versions", type=int, default=KEEP_VERSIONS, help="published versions that stay")
    g = ap.add_argument_group("extracts")
    for name, d in (("", e), ("country-", x)):
        g.add_argument(f"--{name}site-prefix", default=d.site_prefix)
        g.add_argument(f"--{name}completed-from", type=_moment, default=d.completed_from)
        g.add_argument(f"--{name}completed-to", type=_moment, default=d.completed_to)
    g.add_argument("--status", default=e.status)
    g = ap.add_argument_group("report")
    g.add_argument("--start-date", type=_moment, default=a.start_date)
    g.add_argument("--end-date", type=_moment, default=a.end_date)
    g.add_argument("--site", action="append", default=None, help="repeat for several")
    g.add_argument("--site-file", default=None, help="text file with one site a line; any number of them")
    g.add_argument("--batch", action="append", default=None, help="repeat for several; absent: no filter")
    g.add_argument("--strict-null", action="store_true", help="an absent list matches nothing")
    g.add_argument("--industry", action="append", default=None)
    g.add_argument("--group-header", action="append", default=None, help="absent or ALL: every group")
    g.add_argument("--client", action="append", default=None)
    g.add_argument("--corp-id", action="append", default=None)
    return ap


def configs(a: argparse.Namespace) -> tuple:
    """The configurations that the options stand for."""
    commission_cfg = CommissionConfig(a.package_key, a.regular_until, a.bucket_from, a.run_ts)
    extract_cfg = ExtractConfig(a.site_prefix, a.completed_from, a.completed_to, a.status)
    country_cfg = ExtractConfig(a.country_site_prefix, a.country_completed_from, a.country_completed_to, a.status)
    report = AdjudicationConfig()
    report_cfg = dataclasses.replace(
        report, start_date=a.start_date, end_date=a.end_date, sites=tuple(a.site) if a.site else report.sites,
        batches=tuple(a.batch) if a.batch else None, strict_null=a.strict_null)
    sel = ParamSelection(tuple(a.industry or ()), tuple(a.group_header) if a.group_header else None,
                         tuple(a.client or ()), tuple(a.corp_id) if a.corp_id else ParamSelection().corp_ids)
    return commission_cfg, extract_cfg, country_cfg, report_cfg, sel


def main(argv=None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"ledgerline-{a.job}").getOrCreate()
    for k, v in JOB_CONF.items():  # only where the cluster left the default
        if spark.conf.get(k, None) in (None, "") or k.startswith("spark.sql.adaptive"):
            spark.conf.set(k, v)
    if a.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(a.shuffle_partitions))
    commission_cfg, extract_cfg, country_cfg, report_cfg, sel = configs(a)
    if a.site_file:
        report_cfg = dataclasses.replace(report_cfg, sites=spark.read.text(a.site_file))
    if a.job == "commission":
        res = run_commission(spark, a.tables, a.target, commission_cfg, a.keep_versions, a.source)
    elif a.job == "extracts":
        res = run_extracts(spark, a.tables, a.target, extract_cfg, country_cfg, a.source)
    elif a.job == "load":
        res = run_load(spark, a.tables, a.target, a.source, a.buckets)
    elif a.job == "check":
        res = run_check(spark, a.tables, a.target, a.source)
    else:
        res = run_report_dataset(spark, a.tables, a.target, report_cfg, sel, a.source)
    print(json.dumps(res))


if __name__ == "__main__":
    main()


__all__ = ["configs", "open_tables", "parser", "read_current", "run_check", "run_commission", "run_extracts", "run_load",
           "run_report_dataset"]
