"""Quality classifier: naive Bayes support vectors.

Features are indicators of hashed n-grams: words and word pairs, and runs of
one to three word shapes (letters and digits by class, symbols as they are,
runs collapsed, with a mark for a word equal to the one before it). Each
indicator is scaled by the log ratio of its smoothed class counts, the vector
is brought to unit length, and a linear hinge-loss model is fitted by dual
coordinate descent. A logistic curve fitted on a fold that the descent does
not see turns margins into probabilities.

The fit uses at most ``max_rows`` labelled rows (those with the smallest hash
of their id), a documented bound; their sparse features are the only thing
that reaches the driver. Scoring is one pass over all texts without a shuffle.

Defined results: null and empty texts have only the bias and get the score of
that; null ids are not learned from; several labels of one id count as the
lowest; labels other than 0 and 1 are ignored; with no usable labels, or only
one class, every score is the smoothed share of label 1 (0.5 without labels);
repeated rows each get their row; extra columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import text as T
from ledgerline.llm.staging import append_columns, documents

BITS = 18
MAX_ROWS = 12_000
CUT_OFF = 0.3

# byte classes of a shape: lower, upper, digit, other letter bytes; symbols keep their code
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 97, 65, 48, 97


def _runs(codes: np.ndarray, first: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    at, h = T.sequence_hash(codes, first, size, seed)
    return np.searchsorted(first, at, side="right") - 1, T.mix(h + np.uint64(seed))


def _shapes(x: T.Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's shape: its byte classes with runs collapsed."""
    code = _SHAPE[x.data]
    change = np.ones(len(code), dtype=bool)
    change[1:] = code[1:] != code[:-1]
    change[starts] = True
    at = np.flatnonzero(change)
    short = T.Texts(code[at], np.array([0, len(at)]))
    return short.span_hash(short.prefix(), np.searchsorted(at, starts), np.searchsorted(at, ends))


def features(x: T.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs of some texts, each once, in row order."""
    starts, ends, first = x.words()
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    words = x.span_hash(x.prefix(), starts, ends)
    shapes = _shapes(x, starts, ends)
    same = np.zeros(len(words), dtype=bool)
    same[1:] = words[1:] == words[:-1]
    same[first[:-1][first[:-1] < len(words)]] = False
    shapes = np.where(same, T.mix(shapes + np.uint64(1)), shapes)
    rows, marks = [], []
    for codes, size, seed in ((words, 1, 1), (words, 2, 2), (shapes, 1, 3), (shapes, 2, 4), (shapes, 3, 5)):
        r, h = _runs(codes, first, size, seed)
        rows.append(r)
        marks.append(h >> np.uint64(64 - BITS))
    key = np.unique(np.concatenate(rows) << BITS | np.concatenate(marks).astype(np.int64))
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class Model:
    """Bias, per-feature weights (class ratio times fitted weight), squared
    ratios for the length of a vector, and the logistic curve."""
    bias: float
    weight: np.ndarray
    square: np.ndarray
    slope: float
    shift: float

    def margins(self, x: T.Texts) -> np.ndarray:
        row, mark = features(x)
        dot = np.bincount(row, weights=self.weight[mark], minlength=x.rows)
        norm = np.sqrt(np.bincount(row, weights=self.square[mark], minlength=x.rows))
        return dot / np.maximum(norm, 1e-12) + self.bias

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def log_ratios(docs: list[np.ndarray], y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Log ratio of the smoothed, normalised counts of documents of either
    class that hold a feature."""
    size = 1 << BITS
    counts = []
    for label in (1, -1):
        mine = [d for d, t in zip(docs, y) if t == label]
        c = smooth + np.bincount(np.concatenate(mine) if mine else np.zeros(0, dtype=np.int64), minlength=size)
        counts.append(np.log(c / (len(mine) + 2 * smooth)))
    return counts[0] - counts[1]


def dual_descent(docs: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float = 1.0,
                 epochs: int = 12, tolerance: float = 1e-3, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear model that minimises
    ``|w|^2 / 2 + cost * sum of hinge losses``, one dual variable at a time."""
    w, bias = np.zeros(1 << BITS), 0.0
    alpha = np.zeros(len(docs))
    square = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(docs)):
            d, v = docs[i], values[i]
            slope = y[i] * (w[d] @ v + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), cost)
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[d] += step * y[i] * v
                bias += step * y[i]
                worst = max(worst, abs(step))
        if worst < tolerance:
            break
    return w, bias


def logistic_curve(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve through (margin, label), with the
    labels pulled in by one count of either class; Newton steps."""
    n1, n0 = float((y > 0).sum()), float((y < 0).sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = p - target
        h = p * (1 - p) + 1e-9
        gradient = np.array([(g * margin).sum() + 1e-3 * (a - 1), g.sum()])
        hessian = np.array([[(h * margin * margin).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum()]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - np.clip(step[0], -5, 5), b - np.clip(step[1], -5, 5)
        if abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b


def _fit_linear(docs: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Log count ratios, weights and bias from some rows."""
    ratio = log_ratios(docs, y).astype(np.float32)
    values = [(v := ratio[d]) / max(np.sqrt(v @ v), 1e-12) for d in docs]
    w, bias = dual_descent(docs, values, y)
    return ratio, w, bias


def fit(docs: list[np.ndarray], labels: np.ndarray, folds: int = 3) -> Model:
    """``docs``: feature numbers of each labelled row. The logistic curve is
    fitted on margins that each fold gets from a model of the other folds."""
    size = 1 << BITS
    y = np.where(labels == 1, 1, -1)
    if min((y > 0).sum(), (y < 0).sum()) < folds:
        share = (float((y > 0).sum()) + 1) / (len(y) + 2)
        return Model(0.0, np.zeros(size, np.float32), np.zeros(size, np.float32), 1.0, float(np.log(share / (1 - share))))
    fold = np.empty(len(y), dtype=np.int64)
    for label in (1, -1):  # either class is spread over the folds
        fold[y == label] = np.arange((y == label).sum()) % folds
    margin = np.empty(len(y))
    for k in range(folds):
        rest = np.flatnonzero(fold != k)
        ratio, w, bias = _fit_linear([docs[i] for i in rest], y[rest])
        for i in np.flatnonzero(fold == k):
            v = ratio[docs[i]]
            margin[i] = w[docs[i]] @ v / max(np.sqrt(v @ v), 1e-12) + bias
    slope, shift = logistic_curve(margin, y)
    ratio, w, bias = _fit_linear(docs, y)
    return Model(bias, (w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), slope, shift)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Fit on the labelled ids outside the held-out fifth, at most ``max_rows``; of
    the rows that share an id the text with the smallest hash, chosen on Spark."""
    known = (labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y"))
             .filter(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & (F.crc32(F.col("_id").cast("string")) % 5 != 0))
             .groupBy("_id").agg(F.min("_y").alias("_y"))
             .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    rows = (docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
            .join(F.broadcast(known), "_id")
            .groupBy("_id").agg(F.min("_y").alias("_y"), F.min(F.struct(F.xxhash64("_text"), "_text")).alias("_one"))
            .select("_id", "_y", F.col("_one._text").alias("_text")))

    def run(batches):
        for batch in batches:
            for lo, hi, x in T.chunks(batch.column("_text")):
                row, mark = features(x)
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=x.rows))]).astype(np.int32)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_y"),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(mark.astype(np.int32)))],
                    names=["_id", "_y", "_marks"])

    got = rows.mapInArrow(run, "_id long, _y int, _marks array<int>").toArrow().combine_chunks()
    got = got.take(pa.compute.sort_indices(got, sort_keys=[("_id", "ascending")])) if len(got) else got
    got = got.combine_chunks()
    marks = got.column("_marks").combine_chunks() if len(got) else []
    docs_marks = [np.asarray(marks[i].values) for i in range(len(got))]  # 32-bit views of the table
    return fit(docs_marks, np.array(got.column("_y").to_pylist(), dtype=np.int64))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``_quality_score``."""

    def make(column):
        parts = [model.probability(model.margins(x)) for _, _, x in T.chunks(column)]
        return [pa.array(np.concatenate(parts) if parts else np.zeros(0), type=pa.float64())]

    return append_columns(docs, make, "_quality_score double", text_col)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts; the columns of ``docs``."""
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).filter(F.col("_quality_score") >= CUT_OFF).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        F.col("_quality_score").alias("score"), (F.col("_quality_score") >= CUT_OFF).cast("int").alias("predicted"))
