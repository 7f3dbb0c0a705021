"""Vector best-fit packing of tokenised documents into sequences.

A document is its token ids and the end id. Longer ones are cut from the end
into full pieces, so that only the first piece is shorter. Pieces are dealt by
a hash of their place in the written table, so that repeated rows spread, into groups of a bounded size, and each group is packed on its own, the
longest pieces first: a piece goes to the open sequence that, among those with
room under every capacity (tokens, documents, attention cost as the sum of
squared lengths), has the smallest weighted norm of residual capacities
afterwards. A group leaves at most a few sequences part-filled, which is small
against the thousands it fills.

Defined results: null and empty texts are the end id alone; null ids stay
null; repeated rows are packed once each; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import text as T
from ledgerline.llm.bpe import codec, vocabulary_file
from ledgerline.llm.staging import documents, staged

TOKENS = 2048
DOCUMENTS = 2048
ATTENTION = TOKENS * TOKENS
WEIGHTS = (1.0, 1e-3, 1e-2)  # tokens, documents, attention cost: the last two break near ties
END_ID = 0
GROUP_PIECES = 16_384

_PIECES = "_id long, _piece int, _start long, _length long, _crc long, _ids binary"


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: int = TOKENS,
           path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece: its document, number, place, length, the crc32 of its
    ids and, on request, the ids themselves (little-endian unsigned 32-bit)."""
    spec = vocabulary_file(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec)
        for batch in batches:
            for lo, hi, x in T.chunks(batch.column("_text")):
                ids, first = own.encode(x)
                raw = np.insert(ids, first[1:], END_ID).astype("<u4")
                first = first + np.arange(x.rows + 1)
                count = -(-np.diff(first) // tokens)
                doc = np.repeat(np.arange(x.rows), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                ends = first[doc + 1] - (count[doc] - 1 - piece) * tokens
                starts = np.maximum(ends - tokens, first[doc])
                data = raw.tobytes()
                cut = [data[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id").slice(lo, hi - lo).take(pa.array(doc)),
                    pa.array(piece.astype(np.int32)), pa.array(starts - first[doc]), pa.array(ends - starts),
                    pa.array([zlib.crc32(c) for c in cut], type=pa.int64()),
                    pa.array(cut, type=pa.binary()) if keep_ids else pa.nulls(len(doc), pa.binary())],
                    names=[c.split()[0] for c in _PIECES.split(", ")])

    return (docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
            .mapInArrow(run, _PIECES))


def best_fit(lengths: np.ndarray, tokens: int = TOKENS, most_documents: int = DOCUMENTS, attention: float = ATTENTION,
             weights: tuple = WEIGHTS) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and place in it of every piece."""
    sequence = np.empty(len(lengths), dtype=np.int64)
    place = np.empty(len(lengths), dtype=np.int64)
    capacity = np.array([tokens, most_documents, attention], dtype=np.float64)
    scale = np.sqrt(np.array(weights)) / capacity
    order = np.argsort(-lengths, kind="stable")
    size = 1024
    left = np.zeros((3, size))   # residual capacities of open sequences
    number = np.zeros(size, dtype=np.int64)
    n_open = made = 0
    for at in order.tolist():
        length = int(lengths[at])
        need = np.array([length, 1.0, float(length) * length])
        chosen = -1
        if n_open:
            rest = left[:, :n_open] - need[:, None]
            fits = (rest >= 0).all(axis=0)
            if fits.any():
                norm = ((rest * scale[:, None]) ** 2).sum(axis=0)
                norm[~fits] = np.inf
                chosen = int(norm.argmin())
        if chosen < 0:
            if n_open == size:
                left, number = np.concatenate([left, np.zeros_like(left)], axis=1), np.concatenate([number, np.zeros_like(number)])
                size *= 2
            chosen, n_open = n_open, n_open + 1
            left[:, chosen], number[chosen] = capacity, made
            made += 1
        sequence[at], place[at] = number[chosen], tokens - left[0, chosen]
        left[:, chosen] -= need
        if (left[:, chosen] < 1).any():  # full in some respect: the last open one takes its place
            n_open -= 1
            left[:, chosen], number[chosen] = left[:, n_open], number[n_open]
    return sequence, place


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: int = TOKENS,
         most_documents: int = DOCUMENTS, attention: float = ATTENTION, path: str | None = None,
         keep_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence and its offset there."""
    cut = staged(docs.sparkSession, pieces(docs, id_col, text_col, tokens, path, keep_ids)
                 .withColumn("_at", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-cut.count() // GROUP_PIECES))
    dealt = cut.withColumn("_group", F.pmod(F.xxhash64("_at"), F.lit(groups))).drop("_at")

    def fill(table: pa.Table) -> pa.Table:
        lengths = table.column("_length").to_numpy()
        sequence, place = best_fit(lengths, tokens, most_documents, attention)
        base = table.column("_group")[0].as_py() << 32
        return (table.drop_columns("_group").append_column("_sequence", pa.array(sequence + base))
                .append_column("_offset", pa.array(place)))

    return dealt.groupBy("_group").applyInArrow(fill, f"{_PIECES}, _sequence long, _offset long")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs).select(
        F.col("_id").alias("doc_id"), F.col("_piece").alias("piece"), F.col("_start").alias("start"),
        F.col("_length").alias("length"), F.col("_crc").alias("ids_crc32"), F.col("_sequence").alias("sequence_id"),
        F.col("_offset").alias("offset"))


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, documents(spark, sf_dir), sf_dir)
