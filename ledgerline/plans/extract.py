"""File-component extracts: one row per component line of closed files."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.semantics import (
    KEY_SUFFIX, blank_or, ci_eq, ci_norm, ci_starts, is_blank, key_eq, key_ne, key_starts, ts_lit,
)
from ledgerline.operators.joins import any_code_join
from ledgerline.plans.config import COUNTRY_EXTRACT, ExtractConfig
from ledgerline.sources.roles import Roles
from ledgerline.sources.sinks import run_folder, stage_table

col = F.col


def closed_requests(r: Roles, cfg: ExtractConfig) -> DataFrame:
    """Closed files of the site prefix completed in [from, to] (both ends
    inclusive: a completion at exactly ``to`` midnight is kept)."""
    q = r.request
    return q.where(
        key_eq(q, "status", cfg.status)
        & key_starts(q, "site_no", cfg.site_prefix)
        & (col("date_completed") >= ts_lit(cfg.completed_from))
        & (col("date_completed") <= ts_lit(cfg.completed_to)))


def live_detail(r: Roles) -> DataFrame:
    """Detail lines not marked NOTREQ / SUSPENDED (a NULL status is unknown
    under ``<>``, so it is dropped too)."""
    d = r.request_detail
    return d.where(key_ne(d, "status", "NOTREQ") & key_ne(d, "status", "SUSPENDED"))


def component_type(code: Column) -> Column:
    return (F.when(ci_eq(code, "P"), F.lit("Package"))
            .when(ci_starts(code, "F"), F.lit("Fee"))
            .otherwise(F.lit("a la carte")))


def _output(br: DataFrame, bd_cols: dict[str, Column], country: Column) -> list[Column]:
    return [
        br["site_no"].alias("site"),
        br["file_no"].alias("file_number"),
        br["first_name"].alias("applicant_first_name"),
        br["last_name"].alias("applicant_last_name"),
        br["date_requested"].alias("file_request_date"),
        br["date_completed"].alias("file_completed_date"),
        blank_or(bd_cols["report_desc"], bd_cols["report_type"]).alias("component"),
        bd_cols["date_completed"].alias("component_completion_date"),
        bd_cols["unit_price"].alias("component_price"),
        component_type(bd_cols["type_code"]).alias("component_type"),
        country.alias("component_country"),
    ]


_DETAIL_KEYS = ["file_no", "line_no", "unit_price", "date_completed"]
_DETAIL_TEXTS = ["report_desc", "report_type", "type_code", "country"]


def file_component_extract(r: Roles, cfg: ExtractConfig = ExtractConfig(),
                           sort: bool = True, folder: str | None = None) -> DataFrame:
    """Variant A: closed files joined to the DISTINCT detail lines (left
    joined to their international country); country defaults to ``USA``.
    Texts are distinct under the collation, shown by their smallest spelling.

    The qualifying files are written once and read twice: the detail is first
    semi-joined to them so the DISTINCT only shuffles lines that can reach the
    output; its keys include the file number, so it reuses the semi-join's
    partitioning.
    """
    folder = run_folder(r.spark, "extract") if folder is None else folder
    br = stage_table(closed_requests(r, cfg).select(
        "file_no", "site_no", "first_name", "last_name", "date_requested", "date_completed"),
        os.path.join(folder, "closed_requests"))
    d = live_detail(r).join(br.select("file_no"), "file_no", "left_semi")
    d = (d.join(r.detail_international, ["file_no", "line_no"], "left")
         .groupBy(*_DETAIL_KEYS, *[ci_norm(c).alias(f"__{c}") for c in _DETAIL_TEXTS])
         .agg(*[F.min(c).alias(c) for c in _DETAIL_TEXTS])
         .select(*_DETAIL_KEYS, *_DETAIL_TEXTS))
    b = d.alias("b")
    out = br.alias("br").join(b, col("br.file_no") == col("b.file_no"))
    bd = {c: col(f"b.{c}") for c in ["report_desc", "report_type", "date_completed",
                                     "unit_price", "type_code"]}
    country = F.when(is_blank(col("b.country")), F.lit("USA")).otherwise(col("b.country"))
    res = out.select(*_output(br.alias("br"), bd, country),
                     col("b.line_no").alias("_line"))
    if sort:
        res = res.orderBy("file_number", "_line")
    return res.drop("_line")


def file_component_extract_country(r: Roles, cfg: ExtractConfig = COUNTRY_EXTRACT,
                                   sort: bool = True) -> DataFrame:
    """Variant B: no DISTINCT, country description looked up by long OR short
    code (a code shared by two country rows duplicates the line); defaults to
    ``United States``."""
    br = closed_requests(r, cfg).alias("br")
    bd = live_detail(r).alias("bd")
    x = br.join(bd, col("br.file_no") == col("bd.file_no"))
    bi = r.detail_international.select(
        col("file_no").alias("i_file"), col("line_no").alias("i_line"), "country")
    x = x.join(bi, (col("bd.file_no") == bi["i_file"]) & (col("bd.line_no") == bi["i_line"]), "left")
    x = any_code_join(x, r.country_code, "country", ["long_code", "short_code"], "left")
    bdc = {c: col(f"bd.{c}") for c in ["report_desc", "report_type", "date_completed",
                                       "unit_price", "type_code"]}
    country = F.when(is_blank(col("description")), F.lit("United States")).otherwise(col("description"))
    res = x.select(*_output(br, bdc, country), col("bd.line_no").alias("_line"))
    if sort:
        res = res.orderBy("file_number", "_line")
    return res.drop("_line")


def lookup_rows(df: DataFrame, key: str, value) -> DataFrame:
    """``SELECT * FROM t WHERE key = value`` (pushed into the scan), without key
    columns of a load."""
    return df.where(col(key) == F.lit(value)).select([c for c in df.columns if not c.endswith(KEY_SUFFIX)])
