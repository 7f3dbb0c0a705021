"""Column helpers that reproduce the source SQL dialect's comparison, NULL,
date and money rules with built-in Spark expressions only.

Everything here returns a ``Column``; nothing leaves the JVM, so every helper
stays inside whole-stage codegen.

Text comparison follows a case-insensitive collation that ignores trailing
blanks: ``'closed '`` equals ``'CLOSED'`` and ``''`` equals ``'   '``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
PERCENT = "decimal(5,2)"
RATE = "decimal(4,2)"
# Exact working precision for money before the final rounding: four decimals
# (price x quantity) and twenty integer digits.
MONEY_WORK = "decimal(24,4)"
# A rate before it is rounded for display: up to six decimals.
RATE_WORK = "decimal(9,6)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --------------------------------------------------------------------------
# collation-aware text
# --------------------------------------------------------------------------

def ci_norm(col: Column | str) -> Column:
    """Canonical form under the case-insensitive, trailing-blank-insensitive
    collation: upper case, right-trimmed."""
    return F.upper(F.rtrim(_c(col)))


def _norm_lit(value: str) -> str:
    return value.rstrip(" ").upper()


def ci_eq(col: Column | str, value: str) -> Column:
    """``col = 'value'`` under the collation (NULL stays unknown)."""
    return ci_norm(col) == F.lit(_norm_lit(value))


def ci_ne(col: Column | str, value: str) -> Column:
    """``col <> 'value'``; a NULL ``col`` is unknown, so the row is dropped."""
    return ci_norm(col) != F.lit(_norm_lit(value))


def ci_in(col: Column | str, values: Iterable[str | None]) -> Column:
    """``col IN (values)``. NULL members never match; an empty list matches
    nothing."""
    vals = sorted({_norm_lit(v) for v in values if v is not None})
    if not vals:
        return F.lit(False)
    return ci_norm(col).isin(vals)


def ci_starts(col: Column | str, prefix: str) -> Column:
    """``col LIKE 'prefix%'`` (case-insensitive; NULL stays unknown)."""
    return F.upper(_c(col)).startswith(prefix.upper())


def ci_not_starts(col: Column | str, prefix: str) -> Column:
    """``col NOT LIKE 'prefix%'``; NULL is unknown, so such rows drop."""
    return ~ci_starts(col, prefix)


# key columns made at load: the normal form of a text column, beside it
KEY_SUFFIX = "__ci"


def ci_key(df: DataFrame, name: str) -> Column:
    """The normal form of a text column: its key column where the table has one
    (plain comparisons with it reach the scan), else computed."""
    return F.col(name + KEY_SUFFIX) if name + KEY_SUFFIX in df.columns else ci_norm(name)


def key_eq(df: DataFrame, name: str, value: str) -> Column:
    """``ci_eq`` on the key column where there is one."""
    return ci_key(df, name) == F.lit(_norm_lit(value))


def key_ne(df: DataFrame, name: str, value: str) -> Column:
    return ci_key(df, name) != F.lit(_norm_lit(value))


def key_starts(df: DataFrame, name: str, prefix: str) -> Column:
    """``ci_starts`` on the key column where there is one; a prefix that ends
    with a blank needs the column's own trailing blanks."""
    if prefix.endswith(" ") or name + KEY_SUFFIX not in df.columns:
        return ci_starts(name, prefix)
    return F.col(name + KEY_SUFFIX).startswith(prefix.upper())


def key_in(df: DataFrame, name: str, values: Iterable[str | None] | DataFrame) -> DataFrame:
    """The rows whose ``name`` is in a list. A list of values becomes literals; a
    relation (its first column, any number of rows, NULLs and repeated values
    included) is semi-joined, so the plan does not grow with the list."""
    if isinstance(values, DataFrame):
        listed = values.select(ci_norm(F.col(f"`{values.columns[0]}`")).alias("__listed")).distinct()
        return df.join(listed, ci_key(df, name) == listed["__listed"], "left_semi")
    wanted = sorted({_norm_lit(v) for v in values if v is not None})
    return df.where(ci_key(df, name).isin(wanted) if wanted else F.lit(False))


def is_blank(col: Column | str) -> Column:
    """``col IS NULL OR col = ''`` — under the collation ``''`` equals every
    all-blank string."""
    c = _c(col)
    return c.isNull() | (F.rtrim(c) == F.lit(""))


def blank_or(col: Column | str, fallback: Column | str) -> Column:
    """``CASE WHEN col IS NULL OR col = '' THEN fallback ELSE col END``.
    A ``str`` fallback is a literal; pass ``F.col(...)`` for a column."""
    fb = F.lit(fallback) if isinstance(fallback, str) else fallback
    return F.when(is_blank(col), fb).otherwise(_c(col))


# --------------------------------------------------------------------------
# NULL handling
# --------------------------------------------------------------------------

def isnull_typed(col: Column | str, default, type_name: str) -> Column:
    """``ISNULL(col, default)``: the result keeps the type of ``col`` (the
    default is cast to it, unlike a plain coalesce which may widen)."""
    return F.coalesce(_c(col), F.lit(default).cast(type_name))


# --------------------------------------------------------------------------
# dates and int date keys (yyyymmdd)
# --------------------------------------------------------------------------

def int_key_to_date(key: Column | str) -> Column:
    """``CONVERT(DATE, CONVERT(VARCHAR, key))`` for an int ``yyyymmdd`` key."""
    return F.to_date(_c(key).cast("string"), "yyyyMMdd")


def key_year(key: Column | str) -> Column:
    """``LEFT(CONVERT(VARCHAR, key), 4)``."""
    return F.substring(_c(key).cast("string"), 1, 4)


def key_month(key: Column | str) -> Column:
    """``RIGHT(LEFT(CONVERT(VARCHAR, key), 6), 2)``."""
    return F.substring(_c(key).cast("string"), 5, 2)


def date_to_key(d: Column | str) -> Column:
    """``CONVERT(VARCHAR, date, 112)`` landing in an int column."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def first_of_month(year_text: Column | str, month_text: Column | str) -> Column:
    """``CONVERT(DATE, year + '-' + month + '-01')`` from text year/month."""
    return F.make_date(_c(year_text).cast("int"), _c(month_text).cast("int"), F.lit(1))


def ts_lit(value: dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal built from text, so it never passes
    through a time zone (a Python ``datetime`` literal is a zoned timestamp
    and would shift with the session / process time zones)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def days_between(start: Column | str, end: Column | str) -> Column:
    """``DATEDIFF(dd, start, end)``: day boundaries crossed (note the swapped
    argument order of Spark's ``datediff``)."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


# --------------------------------------------------------------------------
# labels and money
# --------------------------------------------------------------------------

def band_label(lo: Column | str, hi: Column | str) -> Column:
    """``CONVERT(VARCHAR, lo) + ' - ' + CONVERT(VARCHAR, hi)``; NULL if either
    bound is NULL (hence ``concat`` and not ``concat_ws``)."""
    return F.concat(_c(lo).cast("string"), F.lit(" - "), _c(hi).cast("string"))


# The three age-band labels the report load rewrites with
# thousands separators, as (stored label, published label).
BAND_RELABEL = (
    ("731 - 1095", "731 - 1,095"),
    ("1462 - 9999", "1,462 - 9,999"),
    ("1096 - 1461", "1,096 - 1,461"),
)


def relabel_band(label: Column | str) -> Column:
    c = _c(label)
    out = None
    for src, dst in BAND_RELABEL:
        out = (F.when(c == src, F.lit(dst)) if out is None
               else out.when(c == src, F.lit(dst)))
    return out.otherwise(c)


# Client-age tiers (days) of the new-business rate card.
TIER_YEAR1 = (1, 365)
TIER_YEAR2 = (366, 730)
TIER_YEAR3 = (731, 1095)


def tier_rate(age: Column | str, yr1: Column | str, yr2: Column | str,
              yr3: Column | str, perpetual: Column | str) -> Column:
    """Rate by client age: 1-365 year-1 rate, 366-730 year-2, 731-1095 year-3,
    anything else (0, negative, NULL) the perpetual rate."""
    a = _c(age)
    return (F.when(a.between(*TIER_YEAR1), _c(yr1))
            .when(a.between(*TIER_YEAR2), _c(yr2))
            .when(a.between(*TIER_YEAR3), _c(yr3))
            .otherwise(_c(perpetual)))


def percent_text(rate: Column | str) -> Column:
    """``CONVERT(VARCHAR, CONVERT(DECIMAL(5,2), rate))`` -> ``'7.50'``."""
    return _c(rate).cast(PERCENT).cast("string")


def pay_amount(base: Column, rate: Column) -> Column:
    """``CONVERT(DECIMAL(18,2), base * (rate / 100.0))`` computed exactly:
    ``base`` at four decimals times the rate as it is (only its *text* is
    rounded) times 0.01 keeps every decimal, so the single final rounding is
    half away from zero."""
    return (base.cast(MONEY_WORK) * rate.cast(RATE_WORK)
            * F.lit(0.01).cast("decimal(3,2)")).cast(MONEY)
