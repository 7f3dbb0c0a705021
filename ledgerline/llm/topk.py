"""Exact top-k inner-product search by columnar branch-and-bound.

Vectors are kept vertically: a block holds up to ``BLOCK`` candidates with one
row per dimension. For every query the scores of a block grow one slice of
dimensions at a time; the mass that a candidate and the query have in the
dimensions still to come bounds what can be added (Cauchy-Schwarz), and after
each slice the candidates whose upper bound is below the k-th best lower bound
are dropped and the rest compacted. A worker keeps the best k of each query it
has met, so later blocks start from a better bound.

Queries are dealt into blocks of bounded size. Every candidate block is moved
once, to its lane, in the narrowest integers that hold the components; the
query blocks, a stated share of the rows, go to every lane, where an equi-join
on the lane lets them meet its candidates. Only the k best of each meeting are
shuffled.

Components are ``floor(scale * x)`` as whole numbers. Defined results: vectors
that are null, hold null or non-finite components, or have a null id take no
part; shorter vectors are filled up with zeros; every row is a candidate of
every query but its own, so an id on several rows can be found several times,
also by the queries that share it; every row of a query id is a query of its
own; equal scores go to the smaller id; an empty table gives an empty result;
other columns are not read. Scores must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm import vectors as V
from ledgerline.llm.staging import input_partitions, staged

BLOCK = 8192
QUERY_BLOCK = 1024
SLICE = 16


def _blocks(dims: int, kind, size: int):
    """Runs of up to ``size`` vectors as one row: row keys, ids and the vertical matrix."""

    def block(keys, ids, rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([keys[0]], type=pa.int64()), *[pa.array([c.tobytes()], type=pa.binary()) for c in
                                                     (keys, ids, np.ascontiguousarray(rows.T))]],
            names=["_key", "_rows", "_ids", "_columns"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append([batch.column("_row").to_numpy(), batch.column("_id").to_numpy(), V.matrix(batch.column("_whole"), dims, kind)])
            n += batch.num_rows
            while n >= size:
                columns = [np.concatenate(c) for c in zip(*held)]
                yield block(*[c[:size] for c in columns])
                held, n = [[c[size:] for c in columns]], n - size
        if n:
            yield block(*[np.concatenate(c) for c in zip(*held)])

    return run


_BLOCK_SCHEMA = "_key long, _rows binary, _ids binary, _columns binary"


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The k best by falling score, then rising id."""
    return np.lexsort((ids, -scores))[:k]


def search_block(queries: np.ndarray, query_rows: np.ndarray, columns: np.ndarray, rows: np.ndarray, ids: np.ndarray,
                 k: int, floors: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query row, candidate ids, scores) of the k best candidates of a block, as
    far as they can be among the best k. ``floors`` holds each query's k best
    scores of earlier blocks."""
    dims, n = columns.shape
    largest = float(max(np.abs(queries).max(initial=0), np.abs(columns).max(initial=0)))
    exact = dims * largest * largest < 2**53  # else whole-number arithmetic, without bounds
    kind = np.float64 if exact else np.int64
    queries, columns = queries.astype(kind), columns.astype(kind)
    edges = [*range(0, dims, SLICE), dims] if dims else [0, 0]

    def mass(x, axis):
        squares = np.square(x.astype(np.float64)).cumsum(axis=axis)
        total = squares.take([-1], axis=axis) if x.shape[axis] else np.zeros(1)
        return np.sqrt(np.maximum(total - squares, 0))

    candidate_mass = mass(columns, 0) if dims else None
    query_mass = mass(queries, 1) if dims else None
    begin = queries[:, :edges[1]] @ columns[:edges[1]]
    for q in range(len(queries)):
        alive = np.flatnonzero(rows != query_rows[q])
        part = begin[q][alive]
        known = floors.get(int(query_rows[q]), np.zeros(0))
        for lo, hi in zip(edges[1:-1], edges[2:]):
            if exact and len(alive) > k:
                open_mass = query_mass[q, lo - 1] * candidate_mass[lo - 1, alive] * (1 + 1e-9) + 1e-6
                lower = part - open_mass
                floor = np.partition(lower, len(lower) - k)[len(lower) - k]
                if len(known) >= k:
                    floor = max(floor, known[-1])
                stay = part + open_mass >= floor
                alive, part = alive[stay], part[stay]
            part = part + queries[q, lo:hi] @ columns[lo:hi, alive]
        best = _best(ids[alive], part, k)
        found, scores = ids[alive[best]], part[best].astype(np.int64)
        floors[int(query_rows[q])] = np.sort(np.concatenate([known, scores]))[::-1][:k]
        yield int(query_rows[q]), found, scores


def _search(dims: int, kind, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict = {}
        for batch in batches:
            for query_rows, queries, rows, ids, columns in zip(*[batch.column(c) for c in (
                    "_query_rows", "_query_columns", "_rows", "_ids", "_columns")]):
                query_rows, rows, ids = (np.frombuffer(c.as_buffer(), np.int64) for c in (query_rows, rows, ids))
                queries = np.frombuffer(queries.as_buffer(), kind).reshape(dims, len(query_rows)).T.astype(np.int64)
                columns = np.frombuffer(columns.as_buffer(), kind).reshape(dims, len(ids)).astype(np.int64)
                if len(floors) > 64 * QUERY_BLOCK:
                    floors.clear()
                found = list(search_block(queries, query_rows, columns, rows, ids, k, floors))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)),
                     pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))],
                    names=["_query", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every row where
    the column ``is_query(id)`` holds."""
    spark = vectors.sparkSession
    usable = (vectors.select(F.col(id_col).cast("long").alias("_id"), V.whole(F.col(vector_col), scale).alias("_whole"))
              .filter(F.col("_id").isNotNull() & F.col("_whole").isNotNull())
              .select(F.monotonically_increasing_id().alias("_row"), "*"))
    usable = staged(spark, usable, "search-vectors")
    dims, low, high = V.extent(usable, "_whole")
    dims, kind, lanes = max(dims, 1), V.narrow(low, high), input_partitions(spark)
    queries = usable.filter(is_query(F.col("_id")))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    dealt = (queries.repartition(query_blocks, "_row").mapInArrow(_blocks(dims, kind, QUERY_BLOCK), _BLOCK_SCHEMA)
             .select(F.col("_rows").alias("_query_rows"), F.col("_columns").alias("_query_columns"),
                     F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("_lane")))
    candidates = (usable.mapInArrow(_blocks(dims, kind, BLOCK), _BLOCK_SCHEMA)
                  .withColumn("_lane", F.pmod(F.xxhash64("_key"), F.lit(lanes)).cast("int")))
    found = (candidates.join(dealt, "_lane").select("_query_rows", "_query_columns", "_rows", "_ids", "_columns")
             .mapInArrow(_search(dims, kind, k), "_query long, vec_id long, score long"))
    order = Window.partitionBy("_query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = queries.select(F.col("_row").alias("_query"), F.col("_id").alias("query_id"))
    return best.join(named, "_query").select("query_id", "rank", "vec_id", "score")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, lambda i: i % 50 == 0)
