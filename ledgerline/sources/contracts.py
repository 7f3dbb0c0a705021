"""Table contracts: names, types, NOT NULL and text limits, kept with a table.

A contract is DDL text (``client_key bigint not null, site_number varchar(50)``).
Its limits become column metadata, which parquet files and catalog tables
keep, so a table that is read back still has them; every sink that writes such
columns checks them (``enforced``). Nothing depends on a metastore.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LENGTH, NOT_NULL = "max_length", "not_null"


class ContractError(ValueError):
    """A table or a select list does not fit its contract."""


@functools.cache
def contract(ddl: str) -> T.StructType:
    """Fields of a contract; text limits and NOT NULL as metadata. Fields are
    nullable for Spark, which would otherwise optimise the checks away. Spark
    reads the DDL, so a session must be there."""
    fields = []
    for f in T.StructType.fromDDL(ddl):
        limits = {} if f.nullable else {NOT_NULL: True}
        kind = f.dataType
        if isinstance(kind, (T.VarcharType, T.CharType)):
            limits[LENGTH], kind = kind.length, T.StringType()
        fields.append(T.StructField(f.name, kind, True, limits))
    return T.StructType(fields)


def limits(df: DataFrame) -> dict[str, dict]:
    """Column -> its limits, as far as it has any."""
    found = {f.name: {k: f.metadata[k] for k in (LENGTH, NOT_NULL) if k in f.metadata} for f in df.schema.fields}
    return {name: kept for name, kept in found.items() if kept}


def with_limits(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` whose columns carry the limits of the contract's fields of their name."""
    by_name = {f.name: f.metadata for f in schema.fields}
    return df.select(*[F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, **by_name.get(f.name, {})})
                       for f in df.schema.fields])


def _checked(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    out = c
    if LENGTH in field.metadata:
        n = int(field.metadata[LENGTH])
        out = F.when(F.length(c) > n, F.raise_error(F.lit(f"value too long for {field.name}"))).otherwise(out)
    if field.metadata.get(NOT_NULL):
        out = F.when(c.isNull(), F.raise_error(F.lit(f"NULL into NOT NULL column {field.name}"))).otherwise(out)
    return out.alias(field.name, metadata=field.metadata)


def enforced(df: DataFrame) -> DataFrame:
    """``df`` with the limits of its columns checked when the rows are written; a
    violation fails the write."""
    found = limits(df)
    if not found:
        return df
    return df.select(*[_checked(f) if f.name in found else F.col(f"`{f.name}`") for f in df.schema.fields])


def insert_select(df: DataFrame, schema: T.StructType, into: Sequence[str] | None = None) -> DataFrame:
    """``INSERT INTO t (into) SELECT ...``: the select list goes to the columns of
    ``into`` (default: all of the contract) by position, whatever its names;
    each value is cast to its column's type, columns left out are NULL, the
    result has the contract's columns, order and limits. Another number of
    values than of columns, an unknown or a repeated column raises."""
    names = [f.name for f in schema.fields]
    into = names if into is None else list(into)
    known = {n.lower(): n for n in names}
    odd = [c for c in into if c.lower() not in known]
    if odd or len({c.lower() for c in into}) != len(into):
        raise ContractError(f"unknown columns {odd}" if odd else f"repeated columns in {into}")
    if len(df.columns) != len(into):
        raise ContractError(f"the select list has {len(df.columns)} values for {len(into)} columns")
    by_place = df.toDF(*[f"_{i}" for i in range(len(into))])
    place = {known[c.lower()]: F.col(f"_{i}") for i, c in enumerate(into)}
    return with_limits(by_place.select(*[place.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                                         for f in schema.fields]), schema)


_WIDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def _fits(found: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of ``found`` is one of ``wanted``."""
    if isinstance(found, (T.VarcharType, T.CharType)):
        found = T.StringType()
    if found == wanted:
        return True
    if type(found) in _WIDER and type(wanted) in _WIDER:
        return _WIDER.index(type(found)) <= _WIDER.index(type(wanted))
    if isinstance(found, T.DecimalType) and isinstance(wanted, T.DecimalType):
        return found.scale <= wanted.scale and found.precision - found.scale <= wanted.precision - wanted.scale
    if type(found) in _WIDER and isinstance(wanted, T.DecimalType):
        return wanted.precision - wanted.scale >= (3, 5, 10, 19)[_WIDER.index(type(found))]
    return isinstance(found, T.FloatType) and isinstance(wanted, T.DoubleType)


def conform(df: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    """The contract's columns of a source table, whose names may differ in case,
    order and by more columns, and whose types may be narrower. All that does
    not fit is reported at once; no row is read for this."""
    have: dict[str, list] = {}
    for f in df.schema.fields:
        have.setdefault(f.name.lower(), []).append(f)
    problems, out = [], []
    for f in schema.fields:
        found = have.get(f.name.lower(), [])
        if len(found) != 1:
            problems.append(f"{f.name}: {'missing' if not found else 'several columns of that name'}")
        elif not _fits(found[0].dataType, f.dataType):
            problems.append(f"{f.name}: {found[0].dataType.simpleString()} where {f.dataType.simpleString()} is due")
        else:
            source = F.col(f"`{found[0].name}`")
            typed = source if found[0].dataType == f.dataType else source.cast(f.dataType)
            out.append(typed.alias(f.name, metadata=f.metadata))
    if problems:
        raise ContractError(f"{name}: " + "; ".join(problems))
    return df.select(*out)


def violations(df: DataFrame, name: str) -> DataFrame:
    """One row (table_name, n_rows, null_violations, long_values): how many values
    break the limits of the columns, from one aggregate pass."""
    zero = F.lit(0).cast("long")
    nulls, longs = [zero], [zero]
    for c, kept in limits(df).items():
        value = F.col(f"`{c}`")
        if kept.get(NOT_NULL):
            nulls.append(F.count_if(value.isNull()))
        if LENGTH in kept:
            longs.append(F.count_if(F.length(value) > int(kept[LENGTH])))
    return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                  sum(nulls[1:], nulls[0]).alias("null_violations"), sum(longs[1:], longs[0]).alias("long_values"))
