"""Vector codes by product quantisation, codebooks trained by ball k-means.

A vector is cut into equal consecutive parts; each part position has its own
codebook, trained by Lloyd rounds over all rows: assign every part to its
nearest entry, then move each entry to the mean of its parts. The assignments
after the first are ball k-means: an entry with its parts is a ball whose
radius is its farthest part. Only entries whose distance from the ball's
centre is at most twice the radius are its neighbours. A part nearer to its
entry than half the way to the nearest neighbour lies in the stable core and
keeps its entry without any distance being taken; the others lie in annular
rings, and a part is compared only with the neighbours up to its ring: by the
triangle inequality no other entry can be nearer or level. All distances are
squared and whole, so the bounds are exact and ties are seen.

Codes of a round are written with the rows, so that the next round starts from
them. A task keeps sums and counts by part and entry (at most ``entries`` times
the dimensions), which Spark adds up; only those totals and the codebooks reach
the driver, whatever the number of rows. The balls are those of a batch's parts.

Defined results: see ``vectors`` for rows that take no part and short vectors;
dimensions that the number of parts does not divide are filled up with zeros;
rows with a null id are coded but start no codebook as long as others are
there; of the rows that share an id the one with the smallest components comes
first; repeated rows each get their row; with fewer rows than entries a
codebook has one entry for each row; an empty table gives an empty result;
null labels are one label; other columns are not read. Sums of a component and
squared distances must fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import vectors as V
from ledgerline.llm.staging import staged

PARTS = 16
ENTRIES = 64
ROUNDS = 2
CELLS = 1 << 21  # distances that a task holds at a time


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every row of ``x``: all entries compared."""
    code = np.zeros(len(x), dtype=np.int64)
    best = np.zeros(len(x), dtype=np.int64)
    step = max(1, CELLS // max(1, book.size))
    for at in range(0, len(x), step):
        distance = np.square(x[at:at + step, None, :] - book[None]).sum(axis=2)
        code[at:at + step] = distance.argmin(axis=1)  # the first of equals
        best[at:at + step] = distance.min(axis=1)
    return code, best


def ball_nearest(x: np.ndarray, book: np.ndarray, code: np.ndarray,
                 count: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The same from the entries of an earlier round, by balls and rings.
    ``count`` gets the number of stable rows and of distances taken."""
    own = np.square(x - book[code]).sum(axis=1)
    between = np.square(book[:, None, :] - book[None]).sum(axis=2)
    np.fill_diagonal(between, np.iinfo(np.int64).max)
    radius = np.full(len(book), -1, dtype=np.int64)
    np.maximum.at(radius, code, own)
    order = np.argsort(between, axis=1, kind="stable")
    ringed = np.take_along_axis(between, order, axis=1)
    neighbours = (ringed <= 4 * radius[:, None]).sum(axis=1)  # an entry at twice the radius may still tie
    code, best = code.copy(), own.copy()
    rings = np.zeros(len(x), dtype=np.int64)
    for i in np.flatnonzero(neighbours):
        mine = np.flatnonzero(code == i)
        rings[mine] = np.searchsorted(ringed[i, :neighbours[i]], 4 * own[mine], side="right")
    open_rows = np.flatnonzero(rings)
    if count is not None:
        count["stable"] = count.get("stable", 0) + len(x) - len(open_rows)
        count["distances"] = count.get("distances", 0) + len(x) + int(rings.sum())
    step = max(1, CELLS // max(1, book.size))
    for at in range(0, len(open_rows), step):
        rows = open_rows[at:at + step]
        many = rings[rows]
        first = np.concatenate([[0], np.cumsum(many)[:-1]])
        place = np.arange(many.sum()) - np.repeat(first, many)
        entry = order[np.repeat(code[rows], many), place]
        distance = np.square(np.repeat(x[rows], many, axis=0) - book[entry]).sum(axis=1)
        least = np.minimum.reduceat(distance, first)
        level = np.where(distance == np.repeat(least, many), entry, len(book))
        entry = np.minimum.reduceat(level, first)
        moves = (least < best[rows]) | ((least == best[rows]) & (entry < code[rows]))
        best[rows] = np.minimum(best[rows], least)
        code[rows[moves]] = entry[moves]
    return code, best


def _assign(batch: pa.RecordBatch, books: np.ndarray, coded: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(components, codes, summed squared distances) of a batch's rows."""
    parts, _, width = books.shape
    x = V.matrix(batch.column("_whole"), parts * width)
    codes = np.zeros((len(x), parts), dtype=np.uint8 if books.shape[1] <= 256 else np.int64)
    error = np.zeros(len(x), dtype=np.int64)
    if coded and len(x):
        before = np.frombuffer(b"".join(batch.column("_codes").to_pylist()), dtype=codes.dtype).reshape(-1, parts)
    for p in range(parts):
        mine = x[:, p * width:(p + 1) * width]
        codes[:, p], distance = (ball_nearest(mine, books[p], before[:, p].astype(np.int64)) if coded and len(x)
                                 else nearest(mine, books[p]))
        error += distance
    return x, codes, error


def _coder(books: np.ndarray, coded: bool, names: list[str]):
    """The rows with ``_codes`` (one index for each part) and ``_error``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, codes, error = _assign(batch, books, coded)
            columns = {n: batch.column(n) for n in names if n not in ("_codes", "_error")}
            columns |= {"_codes": pa.array([c.tobytes() for c in codes], type=pa.binary()), "_error": pa.array(error)}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return run


def _totals(books: np.ndarray):
    """A task's sums: one row for each part, entry and component that occurs,
    component -1 for the count."""
    parts, entries, width = books.shape
    kind = np.uint8 if entries <= 256 else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for batch in batches:
            x = V.matrix(batch.column("_whole"), parts * width)
            codes = np.frombuffer(b"".join(batch.column("_codes").to_pylist()), dtype=kind).reshape(-1, parts)
            for p in range(parts):
                np.add.at(total[p, :, 1:], codes[:, p], x[:, p * width:(p + 1) * width])
                total[p, :, 0] += np.bincount(codes[:, p], minlength=entries)
        p, e, c = np.nonzero((total[:, :, :1] > 0) & np.ones(width + 1, dtype=bool))
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array((c - 1).astype(np.int32)),
             pa.array(total[p, e, c])], names=["part", "entry", "component", "total"])

    return run


def moved(books: np.ndarray, coded: DataFrame) -> np.ndarray:
    """The codebooks with each entry at ``floor(sum / count)`` of its parts."""
    sums = (coded.select("_whole", "_codes").mapInArrow(_totals(books), "part int, entry int, component int, total long")
            .groupBy("part", "entry", "component").agg(F.sum("total").alias("total")).toArrow())  # bounded: see above
    total = np.zeros((*books.shape[:2], books.shape[2] + 1), dtype=np.int64)
    at = [sums.column(c).to_numpy() for c in ("part", "entry", "component")]
    total[at[0], at[1], at[2] + 1] = sums.column("total").to_numpy()
    used = total[:, :, 0] > 0
    out = books.copy()
    out[used] = total[used][:, 1:] // total[used][:, :1]
    return out


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: float = 256.0) -> tuple[DataFrame, np.ndarray]:
    """((``_id``, ``_label``, ``_codes``, ``_error``) rows, codebooks by part,
    entry and component)."""
    spark = vectors.sparkSession
    label = F.col(label_col) if label_col in vectors.columns else F.lit(None).cast("int")
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), label.alias("_label"),
                          V.whole(F.col(vector_col), scale).alias("_whole")).filter(F.col("_whole").isNotNull())
    rows = staged(spark, rows, "ball-vectors")
    dims, _, _ = V.extent(rows, "_whole")
    width = max(1, -(-dims // parts))
    first = (rows.select("_id", "_whole").orderBy(F.col("_id").asc_nulls_last(), "_whole").limit(entries)
             .toArrow().column("_whole").combine_chunks())  # at most ``entries`` rows
    books = V.matrix(first, parts * width).reshape(-1, parts, width).transpose(1, 0, 2).copy()
    if books.shape[1] == 0:
        return (rows.select("_id", "_label", F.lit(None).cast("binary").alias("_codes"), F.lit(0).cast("long").alias("_error")),
                books)
    full = T.StructType([*rows.schema.fields, T.StructField("_codes", T.BinaryType()), T.StructField("_error", T.LongType())])
    coded = rows
    for r in range(rounds):
        coded = staged(spark, coded.mapInArrow(_coder(books, r > 0, full.names), full), "ball-codes")
        books = moved(books, coded)
    coded = coded.mapInArrow(_coder(books, rounds > 0, full.names), full)
    return staged(spark, coded.select("_id", "_label", "_codes", "_error"), "ball-codes"), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of the entries' components by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def decoded(codes: bytes, books: np.ndarray) -> np.ndarray:
    """The whole-number vector that a code stands for."""
    at = np.frombuffer(codes, dtype=np.uint8 if books.shape[1] <= 256 else np.int64)
    return books[np.arange(len(books)), at].ravel()


def op13_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    # one row for each label: written before the join, so that a hot label's rows can be split
    by_label = staged(spark, rows.groupBy("_label").agg(F.sum("_error").alias("label_error"))
                      .withColumnRenamed("_label", "_label_of_sum"), "ball-labels")
    return (rows.join(by_label, F.col("_label").eqNullSafe(F.col("_label_of_sum")))
            .select(F.col("_id").alias("vec_id"), F.lower(F.hex("_codes")).alias("code"), F.col("_error").alias("error"),
                    "label_error", F.lit(digest(books)).alias("codebooks_sha256")))
