"""Pattern matches with their places, in DataFrame functions only.

``matches`` gives, for each leftmost non-overlapping match, the code points
between it and the one before, its length and a group's text; a running sum
over a document's matches (a window by row and kind) turns them into places.
Windows are per document and kind, so no sum is longer than one text's matches.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Kind(NamedTuple):
    """A kind of span: a name, a Java pattern, the group that holds its value and
    a condition on (value, size) that a match must meet."""
    name: str
    pattern: str
    group: int = 0
    keep: object = None


_MATCH = "array<struct<kind:int,at:int,gap:int,size:int,value:string,before:string,after:string>>"
CONTEXT = 24


def matches(text: Column, number: int, kind: Kind) -> Column:
    """The matches of one kind in order, with up to ``CONTEXT`` characters on
    either side (not beyond the next match); none for a text without any."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)) if kind.group else found
    between = F.split(text, kind.pattern, -1)
    parts = F.transform(
        F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("b"), found.alias("f"), values.alias("v"),
                     F.slice(between, F.lit(2), F.size(found)).alias("a")),
        lambda x, i: F.struct(F.lit(number).alias("kind"), i.alias("at"), F.length(x["b"]).alias("gap"),
                              F.length(x["f"]).alias("size"), x["v"].alias("value"),
                              F.right(x["b"], F.lit(CONTEXT)).alias("before"),
                              F.left(x["a"], F.lit(CONTEXT)).alias("after")))
    return F.when(text.rlike(kind.pattern), parts).otherwise(F.array().cast(_MATCH))


def all_matches(text: Column, kinds: Sequence[Kind]) -> Column:
    return F.concat(*[matches(text, i, k) for i, k in enumerate(kinds)])


def placed(rows: DataFrame, found: str, kinds: Sequence[Kind], row: str = "_row") -> DataFrame:
    """One row per match that meets its kind's condition, with ``_kind``,
    ``_start`` and ``_end`` (code points, end exclusive) and ``_value``."""
    others = [c for c in rows.columns if c != found]
    each = rows.select(*others, F.explode(found).alias("_m")).select(*others, "_m.*")
    run = Window.partitionBy(row, "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(run)
    keep = F.lit(True)
    for i, k in enumerate(kinds):
        if k.keep is not None:
            keep = F.when(F.col("kind") == i, k.keep(F.col("value"), F.col("size"))).otherwise(keep)
    return (each.withColumn("_end", end).filter(keep)
            .select(*others, F.col("kind").alias("_kind"), (F.col("_end") - F.col("size")).alias("_start"), "_end",
                    F.col("value").alias("_value"), F.col("before").alias("_before"), F.col("after").alias("_after")))


def listed(spans: Column, kinds: Sequence[Kind]) -> Column:
    """``kind:start:end`` of an array of (start, kind, end) in that order, comma-joined."""
    names = F.array(*[F.lit(k.name) for k in kinds])
    return F.array_join(F.transform(
        F.array_sort(spans),
        lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def span_list(condition: Column) -> Column:
    """Aggregate: the spans of a row that meet a condition, as (start, kind, end)."""
    return F.collect_list(F.when(condition, F.struct(
        F.col("_start").alias("start"), F.col("_kind").alias("kind"), F.col("_end").alias("end"))))


def blanked(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with the spans of a sorted array of (start, end) replaced; what
    overlaps an earlier span is replaced with it."""
    def step(done, x):
        start = x["start"].cast("int")
        return F.struct(
            F.when(start >= done["at"], F.concat(done["out"], F.substring(text, done["at"] + 1, start - done["at"]), F.lit(mark)))
            .otherwise(done["out"]).alias("out"),
            F.greatest(done["at"], x["end"].cast("int")).alias("at"))

    return F.aggregate(
        spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step,
        lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.greatest(F.length(text) - done["at"], F.lit(0)))))
