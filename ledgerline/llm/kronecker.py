"""Hard negatives, scored by Kronecker-packed products.

Components are whole numbers. Biased by the smallest component they are not
negative, so the components that several candidates have in one dimension can
stand side by side in separated fields of one wide integer. An anchor's
component is multiplied with that integer once, which multiplies it with every
field; the sums over the dimensions stay inside their fields, because a field
is as wide as the largest sum that the data allow. Unpacking gives the exact
biased products, and the biases are taken off again with the vectors' sums.
The wide integers are whole doubles while the fields fit 53 bits (a product is
then one matrix product), else 64-bit, else unbounded Python integers.

Blocks of anchors meet blocks of candidates by an equi-join on a lane: every
candidate block is moved once, to its lane, and the anchors, a stated share of
the rows, once to each lane. A meeting returns only its best rows for each
anchor; the best of all are found by rank windows, which Spark cuts to the
wanted number before its shuffle. Two passes: the positives of every anchor,
written, then the negatives below the scores of its positives.

Defined results: see ``vectors`` for rows that take no part and short vectors;
rows with a null label or id take no part, labels are whole numbers; every row
of an anchor's id is an anchor of its own, and only the anchor's own row is no
candidate of it; equal scores go to the smaller id; a positive without
negatives in its band, an anchor without positives and an empty table give no
rows; other columns are not read. A hundred times a score
must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm import vectors as V
from ledgerline.llm.staging import input_partitions, staged

POSITIVES = 5
NEGATIVES = 5
FLOOR_PERCENT = 80
BLOCK = 4096        # candidates of a block
ANCHOR_BLOCK = 2048
CELLS = 1 << 21     # scores that a task holds at a time
ABSENT = np.iinfo(np.int64).min


def field_bits(dims: int, low: int, high: int) -> int:
    """Width of a field: bits of the largest sum of biased products."""
    return max(1, (max(dims, 1) * (high - low) ** 2).bit_length())


class Packed:
    """Candidates (rows of ``x``) packed into wide integers, one for each
    dimension and ``fields`` candidates."""

    def __init__(self, x: np.ndarray, low: int, high: int):
        n, self.dims = x.shape
        self.n, self.low = n, low
        self.bits = field_bits(self.dims, low, high)
        self.kind = np.float64 if self.bits <= 53 else np.int64 if self.bits <= 63 else object
        room = {np.float64: 53, np.int64: 63}.get(self.kind, 4 * self.bits)
        self.fields = room // self.bits
        self.words = -(-n // self.fields)
        self.units = [1 << f * self.bits for f in range(self.fields)]
        if self.kind is not object:
            self.units = [self.kind(u) for u in self.units]
        biased = np.zeros((self.words * self.fields, self.dims), dtype=self.kind)
        biased[:n] = x.astype(self.kind) - low
        self.sums = biased[:n].sum(axis=1)
        self.wide = np.zeros((self.words, self.dims), dtype=self.kind)
        for f, unit in enumerate(self.units):  # candidate f * words + i stands in field f of integer i
            self.wide += biased[f * self.words:(f + 1) * self.words] * unit

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products (anchors by candidates)."""
        a = anchors.astype(self.kind) - self.low
        product = a @ self.wide.T
        out = np.empty((len(a), self.fields * self.words), dtype=np.int64 if self.kind is not object else object)
        for f in range(self.fields - 1, -1, -1):
            top = np.floor(product / self.units[f]) if self.kind is np.float64 else product // self.units[f]
            out[:, f * self.words:(f + 1) * self.words] = top
            product = product - top * self.units[f]
        # with a = a' + low and c = c' + low the score is a'c' + low * (both sums) + dims * low * low
        kind = out.dtype
        out = (out[:, :self.n] + self.low * (a.sum(axis=1).astype(kind)[:, None] + self.sums.astype(kind)[None])
               + self.dims * self.low * self.low)
        return out.astype(np.int64)


def _blocks(size: int, dims: int, kind, scores: int = 0):
    """Runs of up to ``size`` rows as one row of byte columns; with ``scores``
    also their positives' scores, ``ABSENT`` where there are fewer."""
    names = ["_key", "_rows", "_ids", "_labels", "_vectors", *(["_scores"] if scores else [])]

    def block(columns):
        return pa.RecordBatch.from_arrays(
            [pa.array([columns[0][0]]), *[pa.array([c.tobytes()], type=pa.binary()) for c in columns]], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append([*[batch.column(c).to_numpy() for c in ("_row", "_id", "_label")],
                         V.matrix(batch.column("_whole"), dims, kind),
                         *([V.matrix(batch.column("_scores"), scores, fill=ABSENT)] if scores else [])])
            n += batch.num_rows
            while n >= size:
                columns = [np.concatenate(c) for c in zip(*held)]
                yield block([c[:size] for c in columns])
                held, n = [[c[size:] for c in columns]], n - size
        if n:
            yield block([np.concatenate(c) for c in zip(*held)])

    return run


_BLOCK = "_key long, _rows binary, _ids binary, _labels binary, _vectors binary"


def _sides(batch: pa.RecordBatch, dims: int, kind):
    """(anchors, candidates) of every meeting; each (rows, ids, labels, vectors)."""
    names = [f"{side}{c}" for side in ("_a", "") for c in ("_rows", "_ids", "_labels", "_vectors")]
    for raw in zip(*[batch.column(n) for n in names]):
        flat = [np.frombuffer(b.as_buffer(), dtype=kind if k % 4 == 3 else np.int64) for k, b in enumerate(raw)]
        yield [*flat[:3], flat[3].reshape(-1, dims)], [*flat[4:7], flat[7].reshape(-1, dims)]


def best_of_rows(row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each row: falling score, then rising id."""
    order = np.lexsort((ids, -score, row))
    ordered = row[order]
    first = np.searchsorted(ordered, ordered, side="left")
    return order[np.arange(len(order)) - first < k]


def _in_steps(anchors: int, candidates: int) -> Iterator[slice]:
    step = max(1, CELLS // max(candidates, 1))
    for at in range(0, anchors, step):
        yield slice(at, min(at + step, anchors))


def _positives(dims: int, kind, low: int, high: int, k: int):
    """(anchor row, candidate's id, score): of each anchor the k best rows of
    its label in a block, packed label by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (a_rows, _, a_labels, a), (rows, ids, labels, x) in _sides(batch, dims, kind):
                out = [np.zeros((3, 0), dtype=np.int64)]
                for label in np.intersect1d(a_labels, labels):
                    mine, theirs = np.flatnonzero(a_labels == label), np.flatnonzero(labels == label)
                    packed = Packed(x[theirs], low, high)
                    for s in _in_steps(len(mine), len(theirs)):
                        score = packed.scores(a[mine[s]])
                        other = rows[theirs][None] != a_rows[mine[s]][:, None]
                        if len(theirs) > 4 * k:  # keep what reaches the k-th best, ties included
                            least = np.partition(np.where(other, score, ABSENT), -k, axis=1)[:, -k]
                            other &= score >= least[:, None]
                        r, c = np.nonzero(other)
                        found = best_of_rows(r, score[r, c], ids[theirs[c]], k)
                        r, c = r[found], c[found]
                        out.append(np.stack([a_rows[mine[s]][r], ids[theirs[c]], score[r, c]]))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, axis=1)],
                                                 names=["_anchor", "_id", "_score"])

    return run


def _negatives(dims: int, kind, low: int, high: int, k: int, percent: int):
    """(anchor row, positive's rank, candidate's id, score): for each anchor
    and positive the k best rows of other labels in its band of scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, ((a_rows, _, a_labels, a), (_, ids, labels, x)) in zip(batch.column("_a_scores"), _sides(batch, dims, kind)):
                ceilings = np.frombuffer(raw.as_buffer(), dtype=np.int64).reshape(len(a), -1)
                packed = Packed(x, low, high)
                out = [np.zeros((4, 0), dtype=np.int64)]
                for s in _in_steps(len(a), len(x)):
                    score = packed.scores(a[s])
                    top = ceilings[s].max(axis=1)
                    some = np.where(ceilings[s] == ABSENT, top[:, None], ceilings[s]).min(axis=1)
                    r, c = np.nonzero((score <= top[:, None]) & (100 * score >= percent * some[:, None])
                                      & (labels[None] != a_labels[s][:, None]))
                    value, mine = score[r, c], ids[c]
                    for p in range(ceilings.shape[1]):
                        ceiling = ceilings[s][r, p]
                        fit = np.flatnonzero((ceiling != ABSENT) & (value <= ceiling) & (100 * value >= percent * ceiling))
                        fit = fit[best_of_rows(r[fit], value[fit], mine[fit], k)]
                        out.append(np.stack([a_rows[s][r[fit]], np.full(len(fit), p + 1), mine[fit], value[fit]]))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, axis=1)],
                                                 names=["_anchor", "_place", "_id", "_score"])

    return run


def _meet(candidates: DataFrame, anchors: DataFrame, lanes: int) -> DataFrame:
    """Every anchor block beside every candidate block: candidates go to one
    lane each, anchors to all."""
    dealt = candidates.withColumn("_lane", F.pmod(F.xxhash64("_key"), F.lit(lanes)).cast("int")).drop("_key")
    every = anchors.drop("_key").select(*[F.col(c).alias(f"_a{c}") for c in anchors.columns if c != "_key"],
                                        F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("_lane"))
    return dealt.join(every, "_lane").drop("_lane")


def _ranked(df: DataFrame, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("_score"), "_id")
    return df.withColumn("_rank", F.row_number().over(order))


def mine(vectors: DataFrame, is_anchor, id_col: str = "vec_id", label_col: str | Column = "label",
         vector_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES,
         percent: int = FLOOR_PERCENT, scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for the rows where ``is_anchor(id)`` holds, their best rows of the same
    label and, for each, the best rows of other labels that score at most as
    high as it and at least ``percent`` of that."""
    spark = vectors.sparkSession
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    rows = (vectors.select(F.col(id_col).cast("long").alias("_id"), label.cast("long").alias("_label"),
                           V.whole(F.col(vector_col), scale).alias("_whole"))
            .filter(F.col("_id").isNotNull() & F.col("_label").isNotNull() & F.col("_whole").isNotNull())
            .select(F.monotonically_increasing_id().alias("_row"), "*"))
    rows = staged(spark, rows, "negative-rows")
    dims, low, high = V.extent(rows, "_whole")
    dims, kind, lanes = max(dims, 1), V.narrow(low, high), input_partitions(spark)
    chosen = rows.filter(is_anchor(F.col("_id")))
    blocks = staged(spark, rows.mapInArrow(_blocks(BLOCK, dims, kind), _BLOCK), "negative-blocks")
    anchor_blocks = max(1, -(-chosen.count() // ANCHOR_BLOCK))
    first = _meet(blocks, chosen.repartition(anchor_blocks, "_row").mapInArrow(_blocks(ANCHOR_BLOCK, dims, kind), _BLOCK), lanes)
    found = first.mapInArrow(_positives(dims, kind, low, high, positives), "_anchor long, _id long, _score long")
    found = staged(spark, _ranked(found, "_anchor").filter(F.col("_rank") <= positives), "negative-positives")
    # at most ``positives`` scores for each anchor, laid out in its block
    scores = found.groupBy("_anchor").agg(F.array_sort(F.collect_list(F.struct("_rank", "_score"))).alias("_s"))
    scored = (chosen.join(scores, F.col("_row") == F.col("_anchor"))
              .select("_row", "_id", "_label", "_whole", F.col("_s._score").alias("_scores")))
    second = _meet(blocks, scored.repartition(anchor_blocks, "_row")
                   .mapInArrow(_blocks(ANCHOR_BLOCK, dims, kind, positives), _BLOCK + ", _scores binary"), lanes)
    below = second.mapInArrow(_negatives(dims, kind, low, high, negatives, percent),
                              "_anchor long, _place long, _id long, _score long")
    below = _ranked(below, "_anchor", "_place").filter(F.col("_rank") <= negatives)
    positive = found.select(F.col("_anchor").alias("_a"), F.col("_rank").alias("_p"), F.col("_id").alias("positive_id"),
                            F.col("_score").alias("positive_score"))
    named = chosen.select(F.col("_row").alias("_r"), F.col("_id").alias("anchor_id"))
    return (below.join(positive, (F.col("_anchor") == F.col("_a")) & (F.col("_place") == F.col("_p")))
            .join(named, F.col("_anchor") == F.col("_r"))
            .select("anchor_id", "positive_id", F.col("_rank").alias("rank"), F.col("_id").alias("negative_id"),
                    "positive_score", F.col("_score").alias("negative_score")))


def op12_kronecker(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 100 == 0, label_col=label)
