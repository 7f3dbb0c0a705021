"""Quality rules by cross-document line frequency.

One pass reads every text, takes the per-document counts and the 64-bit hash
of every normalised line (words in ASCII lower case, digits as 0, blanks
dropped). A line's frequency on a host is the number of documents (rows) of
that host that hold it, exact copies included. Lines above
``max_docs_per_host`` go; a document left with fewer than ``min_words`` words
or less than ``min_kept_share`` of its words is depleted and rejected.

Defined results: null text is empty, a null host is the host ``""``, a null id
stays null; an empty text has no words and fails the base rule; repeated rows
each get their own row; an empty table gives an empty result; other columns
are not read. Only (host, line) counts are shuffled, combined before the
shuffle; the frequent lines are written before they are joined, so that the
adaptive planner can split the join where one line is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import text as T
from ledgerline.llm.staging import documents, staged

MAX_DOCS_PER_HOST = 50
MIN_WORDS = 20
MIN_KEPT_SHARE = 0.3
REPEAT_SIZE = 8
MAX_REPEAT_PERCENT = 30

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[48:58] = 48

_COUNTS = ("_key long, _id long, _host string, _text_hash long, n_words long, word_chars long, n_symbols long, "
           "n_dup_lines long, n_repeat_words long, _lines array<long>, _line_words array<int>")


def _lines(x: T.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, byte start and byte end of every line (split at each newline)."""
    cut = np.flatnonzero(x.data == 10)
    rows = np.concatenate([np.arange(x.rows), np.searchsorted(x.offsets, cut, side="right") - 1])
    starts = np.concatenate([x.offsets[:-1], cut + 1])
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    ends = x.offsets[rows + 1].copy()
    same = rows[1:] == rows[:-1]
    ends[:-1][same] = starts[1:][same] - 1
    return rows, starts, ends


def _normal_lines(x: T.Texts):
    """Lines that hold a word: row, byte start, byte end, raw hash, normalised
    hash, number of words; and the word table of the texts."""
    starts, ends, first = x.words()
    prefix = x.prefix()
    words = x.span_hash(prefix, starts, ends)
    folded = T.Texts(_FOLD[x.data], x.offsets)
    normal = folded.span_hash(folded.prefix(), starts, ends)
    rows, lo, hi = _lines(x)
    w0, w1 = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
    has = w1 > w0
    rows, lo, hi, w0, w1 = rows[has], lo[has], hi[has], w0[has], w1[has]
    raw = x.span_hash(prefix, lo, hi)
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(normal * T._powers(T._MULT, len(words)), out=total[1:])
    folded_hash = T.mix((total[w1] - total[w0]) * T._powers(T._MULT_INV, len(words) + 1)[w0])
    return rows, lo, hi, raw, folded_hash, w1 - w0, (starts, ends, first, words)


def _by_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return T.mix(hashes + T.mix(rows.astype(np.uint64) + np.uint64(1)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, x in T.chunks(batch.column("_text")):
            rows, _, _, raw, normal, n, (starts, ends, first, words) = _normal_lines(x)
            n_words = np.diff(first)
            letters = np.zeros(len(x.data) + 1, dtype=np.int64)
            np.cumsum((x.data & 0xC0) != 0x80, out=letters[1:])
            word_chars = T.per_row(letters[ends] - letters[starts], first)
            symbols = np.zeros(len(x.data) + 1, dtype=np.int64)
            np.cumsum(_SYMBOL[x.data], out=symbols[1:])
            _, earliest = np.unique(_by_row(raw, rows), return_index=True)
            again = np.ones(len(rows), dtype=np.int64)
            again[earliest] = 0
            at, h = T.sequence_hash(words, first, REPEAT_SIZE)
            _, back, times = np.unique(_by_row(h, np.searchsorted(first, at, side="right") - 1),
                                       return_inverse=True, return_counts=True)
            repeat = T.covered(at[times[back] > 1], REPEAT_SIZE, len(words))
            _, at, back = np.unique(_by_row(normal, rows), return_index=True, return_inverse=True)
            sums = np.bincount(back, weights=n, minlength=len(at)).astype(np.int32)
            order = np.argsort(rows[at], kind="stable")
            ends_of = np.concatenate([[0], np.cumsum(np.bincount(rows[at], minlength=x.rows))]).astype(np.int32)
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([
                part.column("_key"), part.column("_id"), part.column("_host"), part.column("_text_hash"),
                pa.array(n_words.astype(np.int64)), pa.array(word_chars),
                pa.array(symbols[x.offsets[1:]] - symbols[x.offsets[:-1]]),
                pa.array(np.bincount(rows, weights=again, minlength=x.rows).astype(np.int64)),
                pa.array(T.per_row(repeat, first)),
                pa.ListArray.from_arrays(pa.array(ends_of), pa.array(normal[at][order].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(ends_of), pa.array(sums[order]))],
                names=[c.split()[0] for c in _COUNTS.split(", ")])


def _counted(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    source = docs.select(
        F.monotonically_increasing_id().alias("_key"), F.col(id_col).cast("long").alias("_id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("_host"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_text_hash"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return staged(docs.sparkSession, source.mapInArrow(_count, _COUNTS), "line-frequency")


def frequent_lines(counted: DataFrame, max_docs_per_host: int = MAX_DOCS_PER_HOST) -> DataFrame:
    """(host, line hash, number of documents) of every line above the limit,
    written: a join straight on top of the grouping would keep all documents
    of a hot line in one task. A document's lines are distinct already, so
    the count is combined before the shuffle."""
    frequent = (counted.select("_host", F.explode("_lines").alias("_line"))
                .groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_docs"))
                .filter(F.col("_docs") > max_docs_per_host))
    return staged(counted.sparkSession, frequent, "frequent-lines")


def line_frequency(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                   max_docs_per_host: int = MAX_DOCS_PER_HOST, min_words: int = MIN_WORDS,
                   min_kept_share: float = MIN_KEPT_SHARE) -> DataFrame:
    """One row per document: base counts, words in removed lines, verdict and
    the hashes of its removed lines."""
    counted = _counted(docs, id_col, text_col, host_col)
    removed = (counted.select("_key", "_host", F.explode(F.arrays_zip("_lines", "_line_words")).alias("_l"))
               .select("_key", "_host", F.col("_l._lines").alias("_line"), F.col("_l._line_words").alias("_n"))
               .join(frequent_lines(counted, max_docs_per_host).select("_host", "_line"), ["_host", "_line"])
               .groupBy("_key").agg(F.sum("_n").cast("long").alias("_gone"), F.collect_list("_line").alias("_cut")))
    left = F.col("n_words") - F.col("n_removed_words")
    base_failed = ((F.col("n_words") < MIN_WORDS)
                   | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    depleted = (left < min_words) | (left < min_kept_share * F.col("n_words"))
    return (counted.drop("_lines", "_line_words").join(removed, "_key", "left")
            .withColumn("n_removed_words", F.coalesce("_gone", F.lit(0).cast("long")))
            .withColumn("base_failed", base_failed)
            .withColumn("depleted", depleted)
            .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
            .withColumn("removed_lines", F.coalesce("_cut", F.array().cast("array<long>"))))


def _cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = batch.column("_cut").to_pylist()
        for lo, hi, x in T.chunks(batch.column("_text")):
            rows, starts, ends, _, normal, _, _ = _normal_lines(x)
            keep = np.ones(len(x.data), dtype=bool)
            for i in np.flatnonzero([bool(g) for g in gone[lo:hi]]):
                mine = np.flatnonzero(rows == i)
                bad = np.isin(normal[mine].view(np.int64), np.array(gone[lo + i], dtype=np.int64))
                for k in mine[bad]:
                    keep[starts[k]:min(ends[k] + 1, x.offsets[i + 1])] = False
            texts = [x.data[a:b][keep[a:b]].tobytes().decode() for a, b in zip(x.offsets[:-1], x.offsets[1:])]
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(texts, type=pa.string())],
                                             names=["_row", "_text"])


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    **limits) -> DataFrame:
    """The kept documents with their frequent lines cut out; all columns of ``docs``."""
    found = (line_frequency(docs, id_col, text_col, host_col, **limits).filter("kept")
             .select(F.col("_id"), F.col("_host"), F.col("_text_hash"), F.col("removed_lines").alias("_cut"))
             .dropDuplicates(["_id", "_host", "_text_hash"]))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    keyed = rows.select("_row", F.col(f"_row.{id_col}").cast("long").alias("_id0"),
                        F.coalesce(F.col(f"_row.{host_col}").cast("string"), F.lit("")).alias("_host0"),
                        F.coalesce(F.col(f"_row.{text_col}"), F.lit("")).alias("_text"))
    joined = keyed.join(found, F.col("_id0").eqNullSafe(F.col("_id")) & (F.col("_host0") == F.col("_host"))
                        & (F.xxhash64("_text") == F.col("_text_hash")))
    cut = joined.select("_row", "_text", "_cut").mapInArrow(
        _cut_lines, joined.select("_row", "_text").schema)
    return cut.select(*[F.col("_text").alias(c) if c == text_col else F.col(f"_row.{c}") for c in docs.columns])


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency(documents(spark, sf_dir)).select(
        F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed_words", "depleted")
