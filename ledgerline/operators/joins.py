"""Join operators the reports need beyond a plain equi-join.

Each one is re-expressed as an equi-join (hash or sort-merge) so no plan
falls back to a nested-loop or cartesian product:

* ``range_join``        value BETWEEN lo AND hi      -> level + bucket equi-join, filter
* ``any_code_join``     dim.a = x OR dim.b = x         -> explode codes, equi-join
* ``first_by_order``    correlated TOP 1 ... ORDER BY  -> grouped ``min_by``
* ``single_value_lookup`` scalar sub-query (<= 1 row)  -> grouped count + check
* ``any_row_lookup``    TOP 1 without ORDER BY         -> grouped min / max

No operator runs a Spark action while a plan is built and none hints a
broadcast: Spark (from file statistics) and AQE (from runtime bytes) decide
which side is small enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.semantics import ci_norm

# A range is cut into at most this many buckets of its level (plus one at an end).
BUCKETS_PER_RANGE = 64
# Bucket widths of the levels: powers of BUCKETS_PER_RANGE that fit a long.
LEVELS = 10


def _bucket(value: Column, level: Column) -> Column:
    """``floor(value / BUCKETS_PER_RANGE ** level)`` of a long, exactly."""
    return F.call_function("shiftright", value, (level * 6).cast("int"))


def range_join(facts: DataFrame, ranges: DataFrame, value: str, lo: str, hi: str) -> DataFrame:
    """``facts JOIN ranges ON facts.value BETWEEN ranges.lo AND ranges.hi``.

    Every range gets a level from its own length: the smallest power of
    BUCKETS_PER_RANGE as bucket width that cuts it into at most
    BUCKETS_PER_RANGE buckets, so a catch-all range does not widen the buckets
    of narrow ones. A range is exploded into the buckets it covers (at most
    BUCKETS_PER_RANGE + 1 rows); a fact is looked up in its bucket of each
    level that occurs (at most LEVELS, found by a scalar sub-query when the
    query runs). The exact BETWEEN stays as the join's residual filter:
    overlapping ranges still multiply rows, a value outside every range (or
    NULL) finds none, and nothing is capped.
    """
    level, bucket = "__range_level", "__range_bucket"
    start, end = F.col(lo).cast("long"), F.col(hi).cast("long")
    fit = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        fit = F.when(F.try_subtract(end, start) < BUCKETS_PER_RANGE ** (k + 1), F.lit(k)).otherwise(fit)
    usable = ranges.where(start <= end).withColumn(level, fit)
    levels = usable.agg(F.collect_set(level).alias("l")).scalar()
    at = F.col(level)
    r = usable.withColumn(bucket, F.explode(F.sequence(_bucket(start, at), _bucket(end, at))))
    f = (facts.where(F.col(value).isNotNull()).withColumn(level, F.explode(levels))
         .withColumn(bucket, _bucket(F.col(value).cast("long"), at)))
    cond = (f[level] == r[level]) & (f[bucket] == r[bucket]) & f[value].between(r[lo], r[hi])
    return (f.join(r, cond).drop(f[level]).drop(r[level]).drop(f[bucket]).drop(r[bucket]))


def any_code_join(facts: DataFrame, dim: DataFrame, fact_key: str,
                  code_cols: Sequence[str], how: str = "left") -> DataFrame:
    """``facts JOIN dim ON dim.c1 = facts.k OR dim.c2 = facts.k ...`` under the
    collation (case and trailing blanks do not matter).

    Each dim row is exploded into its *distinct* normalised codes, so a row
    whose codes are equal matches once, while a code shared by several dim
    rows fans out exactly like the disjunctive join.
    """
    code = "__any_code"
    d = dim.withColumn(code, F.explode(F.array_distinct(F.array(*[ci_norm(c) for c in code_cols]))))
    return facts.join(d, ci_norm(facts[fact_key]) == d[code], how).drop(d[code])


def first_rank(order: Column, value: Column, condition: Column | None = None) -> Column:
    """Order of a row in ``TOP 1 value ... ORDER BY order``: NULL orders first,
    ties by the smallest value, NULL (skipped by ``min_by``) where the
    condition does not hold."""
    rank = F.struct(order.isNotNull().alias("has"), order.alias("o"), value.alias("v"))
    return rank if condition is None else F.when(condition, rank)


def first_by_order(df: DataFrame, keys: Sequence[str], order_col: str, value_col: str,
                   out: str) -> DataFrame:
    """Per ``keys``, the ``value_col`` of the first row ordered by
    ``order_col`` ascending with NULLs first (ties: smallest value).

    A bare ``min_by`` on the date would skip a NULL-dated row; ``first_rank``
    keeps it first. It is a partial aggregate, so a hot key is combined
    map-side before the shuffle.
    """
    return df.groupBy(*keys).agg(
        F.min_by(F.col(value_col), first_rank(F.col(order_col), F.col(value_col))).alias(out))


def single_value_lookup(df: DataFrame, keys: Sequence[str], value_col: str, out: str,
                        what: str = "lookup") -> DataFrame:
    """A scalar sub-query that must return at most one row per key.

    Returns ``keys + [out, out__n]``; apply ``check_single`` after joining so
    that, as in the source, only keys actually looked up raise the error.
    """
    return df.groupBy(*keys).agg(
        F.first(F.col(value_col)).alias(out),  # value if the count is 1
        F.count(F.lit(1)).alias(f"{out}__n"))


def check_single(out: str, what: str) -> Column:
    """Value of a ``single_value_lookup`` column, raising when >1 row matched."""
    n = F.col(f"{out}__n")
    return (F.when(n > 1, F.raise_error(F.lit(f"subquery returned more than 1 value: {what}")))
            .otherwise(F.col(out)))


def any_row_lookup(df: DataFrame, keys: Sequence[str], value_col: str, out: str,
                   pick: str = "min") -> DataFrame:
    """``TOP 1`` without ``ORDER BY``: any row is legal; we fix a
    deterministic choice (``min`` or ``max``) computed as a partial aggregate."""
    agg = F.min if pick == "min" else F.max
    return df.groupBy(*keys).agg(agg(F.col(value_col)).alias(out))


def anti_on(left: DataFrame, right: DataFrame, cond: Column | Sequence[str]) -> DataFrame:
    """``LEFT JOIN right ... WHERE right.key IS NULL`` written as the anti-join
    it means (Catalyst keeps outer join + filter otherwise)."""
    return left.join(right, cond, "left_anti")
