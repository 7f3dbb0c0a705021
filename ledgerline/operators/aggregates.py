"""Aggregation operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_sums(df: DataFrame, keys: Sequence[str], value: str,
                     conds: Mapping[str, Column | None]) -> DataFrame:
    """One pass computing ``SUM(value) FILTER (WHERE cond)`` for each named
    condition (``None`` = every row). A group with no qualifying row yields
    NULL, like a correlated ``SELECT SUM(...)`` that finds nothing."""
    v = F.col(value)
    aggs = [F.sum(v if c is None else F.when(c, v)).alias(name) for name, c in conds.items()]
    return df.groupBy(*keys).agg(*aggs)


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``SELECT DISTINCT`` over ``cols`` (all columns by default)."""
    return (df.select(*cols) if cols else df).distinct()


def spread_rows(df: DataFrame) -> DataFrame:
    """The same rows shuffled by their whole content, for a grouping on a nearly
    unique key. Grouped where it is read, such a table fills a map with a row for
    each row of the task, and a task reads a parquet row group at least, however
    large; after a shuffle sized by the input the tasks are bounded. A hot key
    still spreads over tasks that combine it before the grouping's own shuffle.
    Select the needed columns first."""
    return df.repartition(*df.columns)
