"""Cascading report-parameter lists: industry -> client group -> corp id ->
site. Each list is a DISTINCT over the client table filtered by the earlier
choices, sorted for display."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.semantics import ci_in, ci_norm, ci_not_starts, is_blank, key_in
from ledgerline.plans.config import ParamSelection
from ledgerline.sources.roles import Roles

col = F.col

ALL_CORP = " All"  # the all-value carries a leading blank
ALL_GROUPS = "ALL"


def _same(a: str | None, b: str) -> bool:
    """Equality under the collation: case and trailing (not leading) blanks
    do not matter."""
    return a is not None and a.rstrip(" ").upper() == b.rstrip(" ").upper()


def _distinct(df: DataFrame, *columns: str) -> DataFrame:
    """``SELECT DISTINCT`` under the collation; of equal texts the smallest
    spelling is shown."""
    keys = [ci_norm(c).alias(f"__{c}") for c in columns]
    return df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in columns]).select(*columns)


def _literal_row(r: Roles, **cols) -> DataFrame:
    """A one-row literal source (``SELECT 'BLANK', ''``)."""
    return r.spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in cols.items()])


def param_industry(r: Roles) -> DataFrame:
    """Distinct non-blank industries of active clients outside the PSTS /
    TEST sites, plus a ``BLANK`` row, sorted."""
    c = r.client_list.where(
        ci_not_starts("site_no", "PSTS") & ci_not_starts("site_no", "TEST")
        & (col("active") == 1) & ~is_blank("industry") & col("industry").isNotNull())
    lst = _distinct(c, "industry").withColumn("industry_key", col("industry"))
    return lst.unionByName(_literal_row(r, industry="BLANK", industry_key="")).orderBy("industry")


def in_groups(df: DataFrame, sel: ParamSelection) -> DataFrame:
    """``group IN (hdr) OR LEFT(group, 4) IN (hdr) OR hdr-is-ALL``.

    ``@Group`` is 'ALL' when the header is not set or is the text ALL; the
    sentinel is resolved on the driver so the filter folds away. Headers are
    the few that a user picks, so they stay literals."""
    hdr = sel.group_header
    if hdr is None or any(_same(h, ALL_GROUPS) for h in hdr):
        return df
    return df.where(ci_in("group_no", hdr) | ci_in(F.left(col("group_no"), F.lit(4)), hdr))


def param_client_group(r: Roles, sel: ParamSelection) -> DataFrame:
    c = key_in(in_groups(r.client_list, sel), "industry", sel.industries)
    return (_distinct(c, "group_no").select(col("group_no").alias("client"), col("group_no").alias("group_key"))
            .orderBy("client"))


def param_corp(r: Roles, sel: ParamSelection) -> DataFrame:
    c = key_in(key_in(r.client_list, "group_no", sel.clients), "industry", sel.industries)
    return _distinct(c, "corp_id").unionByName(_literal_row(r, corp_id=ALL_CORP)).orderBy("corp_id")


def param_site(r: Roles, sel: ParamSelection) -> DataFrame:
    """Sites (label ``site | company``; a NULL company gives a NULL label)
    for the chosen groups, industries and corp ids (or the ' All' value)."""
    c = key_in(key_in(r.client_list, "group_no", sel.clients), "industry", sel.industries)
    if isinstance(sel.corp_ids, DataFrame) or not any(_same(x, ALL_CORP) for x in sel.corp_ids):
        c = key_in(c, "corp_id", sel.corp_ids)
    c = c.select(F.concat(col("site_no"), F.lit(" | "), col("company_name")).alias("site_name"),
                 col("site_no").alias("client_key"))
    return _distinct(c, "site_name", "client_key").orderBy("site_name")
