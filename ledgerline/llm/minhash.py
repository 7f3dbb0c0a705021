"""Near-duplicate documents by MinHash with sequential Bayesian verification.

Equal texts are one node. A node's set holds the distinct runs of ``size``
lower-cased words; its signature has one minimum for each of ``BANDS * ROWS``
hash functions, and every band of minima posts the node in a bucket. A pair at
the wanted similarity misses all buckets with probability
``(1 - similarity**ROWS)**BANDS`` (3e-7 at 0.85).

A candidate pair is compared batch by batch of signature places. After a batch
with m equal places of n the posterior of the similarity (uniform prior, one
byte a place) says how probable it still is that the pair reaches the limit;
once that is below ``MISS`` the pair is dropped. Survivors are verified on the
full sets of word runs, as text.

Buckets are never paired up. First every member meets only its bucket's
smallest node, which links groups of near copies as stars. Components are
found, and buckets whose other members now all lie in one component are
finished: no pair in them can change the result. In the others the members
outside the bucket's largest component meet all its members, dealt in blocks
of about ``BLOCK`` members and ``ELEMENTS`` word runs on a side. A pair is looked
at in the first bucket that it shares; the pairs that the posterior leaves stay
in their block, the texts of their members are brought to it once each, and the
pairs are verified from the most similar on, as long as their components are
apart. So every candidate pair between two components is either dropped by its
posterior or verified, and what is moved grows with members, not with pairs.

Defined results: null, blank and empty texts have an empty set, are linked with
nothing and are their own component; a text with fewer than ``size`` words has
its whole sequence as its one element; rows with a null id belong to a
component and get its smallest id (null if no row has one) and are not kept;
repeated rows each get their row; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import text as T
from ledgerline.llm.components import components
from ledgerline.llm.staging import documents, staged

SIZE = 5
PERCENT = 85
ROWS = 6
BANDS = 32
PLACES = ROWS * BANDS
BATCH = 32      # places compared between two looks at the posterior
MISS = 1e-7     # a pair is dropped when it reaches the limit with less probability
BLOCK = 2048
ELEMENTS = 1 << 20

_rng = np.random.default_rng(11)
_A = _rng.integers(1, 1 << 63, size=PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1, 1 << 63, size=PLACES, dtype=np.uint64)
_JOIN = _rng.integers(1, 1 << 63, size=ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---------------------------------------------------------------- signatures

def element_hashes(x: T.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit hash) of every distinct element of every row's set, by row."""
    x = x.lower_ascii()
    starts, ends, first = x.words()
    words = x.span_hash(x.prefix(), starts, ends)
    at, hashes = T.sequence_hash(words, first, size)
    rows = np.searchsorted(first, at, side="right") - 1
    counts = np.diff(first)
    parts = [(rows, hashes)]
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            parts.append((short, T.rolling(words, n, seed=size + n)[first[short]]))
    rows, hashes = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def signatures_of(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows with elements, their set sizes, one byte for each place, bucket of each band)."""
    full, first, sizes = np.unique(rows, return_index=True, return_counts=True)
    least = np.empty((len(full), PLACES), dtype=np.uint64)
    for k in range(PLACES):
        if len(full):
            least[:, k] = np.minimum.reduceat((hashes * _A[k] + _B[k]) >> np.uint64(32), first)
    bands = T.mix((least.reshape(-1, BANDS, ROWS) * _JOIN).sum(axis=2) + np.arange(1, BANDS + 1, dtype=np.uint64) * _JOIN[0])
    return full, sizes, (least & np.uint64(255)).astype(np.uint8), bands


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("_node").to_numpy()
            for lo, hi, x in T.chunks(batch.column("_text")):
                rows, sizes, places, bands = signatures_of(*element_hashes(x, size))
                yield pa.RecordBatch.from_arrays([
                    pa.array(nodes[lo:hi][rows]), pa.array(sizes.astype(np.int64)),
                    pa.array([p.tobytes() for p in places], type=pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)),
                                             pa.array(bands.ravel().view(np.int64)))],
                    names=["_node", "_n", "_places", "_bands"])

    return run


# ---------------------------------------------------------------- posterior

@functools.cache
def least_matches(percent: int, miss: float) -> tuple[int, ...]:
    """For each batch the fewest equal places with which the probability that
    the similarity reaches the limit is not below ``miss``."""
    grid = (np.arange(4000) + 0.5) / 4000
    equal = grid + (1 - grid) / 256  # places agree by chance in one of 256 cases
    reaches = grid >= percent / 100
    out = []
    for n in range(BATCH, PLACES + 1, BATCH):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(equal) + (n - m) * np.log1p(-equal)
        weight = np.exp(log - log.max(axis=1, keepdims=True))
        out.append(int(np.argmax((weight * reaches).sum(axis=1) / weight.sum(axis=1) >= miss)))
    return tuple(out)


def survivors(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int,
              miss: float) -> tuple[np.ndarray, np.ndarray]:
    """(pair numbers, equal places) of the pairs (``a[i]``, ``b[i]``) of rows of
    ``left`` and ``right`` that no batch drops."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
    for k, bound in enumerate(least_matches(percent, miss)):
        place = slice(k * BATCH, (k + 1) * BATCH)
        equal = equal + (left[a[alive], place] == right[b[alive], place]).sum(axis=1)
        stay = equal >= bound
        alive, equal = alive[stay], equal[stay]
    return alive, equal


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)


def _posterior(percent: int, miss: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                every = np.arange(batch.num_rows)
                kept, _ = survivors(every, every, _matrix(batch.column("_places")), _matrix(batch.column("_places_b")),
                                    percent, miss)
                yield batch.select(["a", "b"]).take(pa.array(kept))

    return run


def _alike(n: str, m: str, percent: int):
    """Set sizes that allow the similarity."""
    return (100 * F.least(n, m) >= percent * F.greatest(n, m))


def likely(pairs: DataFrame, signatures: DataFrame, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """The pairs (``a``, ``b``) that sequential comparison does not drop."""
    one = signatures.select(F.col("_node").alias("a"), F.col("_n").alias("_na"), "_places")
    two = signatures.select(F.col("_node").alias("b"), F.col("_n").alias("_nb"), F.col("_places").alias("_places_b"))
    return (pairs.join(one, "a").join(two, "b").filter(_alike("_na", "_nb", percent))
            .select("a", "b", "_places", "_places_b").mapInArrow(_posterior(percent, miss), "a long, b long"))


# ---------------------------------------------------------------- verification

def elements(text: str, size: int, numbers: dict | None = None) -> set:
    """The set of a text: its distinct runs of ``size`` lower-cased words, as
    their ``numbers`` where a table of them is given (and grown)."""
    words = text.encode().lower().split()  # bytes: A-Z only; cuts at \\x20 and \\x09-\\x0D
    if len(words) < size:
        runs = {tuple(words)} if words else set()
    else:
        runs = set(zip(*[words[k:] for k in range(size)]))
    return runs if numbers is None else {numbers.setdefault(r, len(numbers)) for r in runs}


def alike(one: set, two: set, percent: int) -> bool:
    both = len(one & two)
    return 100 * both >= percent * (len(one) + len(two) - both)


def _verify(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, mine = None, set()
        for batch in batches:
            linked = []
            for i, (a, one, two) in enumerate(zip(batch.column("a").to_pylist(), batch.column("_text_a"), batch.column("_text_b"))):
                if a != node:  # after the join by a, the pairs of one node stand together
                    node, mine = a, elements(one.as_py(), size)
                if alike(mine, elements(two.as_py(), size), percent):
                    linked.append(i)
            yield batch.select(["a", "b"]).take(pa.array(linked, type=pa.int64()))

    return run


def texts_of(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(``_node``, ``_text``) of some nodes, written: only these texts are moved later."""
    needed = staged(nodes.sparkSession, nodes.distinct(), "minhash-needed")
    return staged(nodes.sparkSession, texts.select("_node", "_text").join(needed, "_node", "left_semi"), "minhash-needed-texts")


def verified(pairs: DataFrame, texts: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The pairs whose full sets reach the limit."""
    needed = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("_node")), texts)
    one = needed.select(F.col("_node").alias("a"), F.col("_text").alias("_text_a"))
    two = needed.select(F.col("_node").alias("b"), F.col("_text").alias("_text_b"))
    return (pairs.join(two, "b").join(one, "a").select("a", "b", "_text_a", "_text_b")
            .mapInArrow(_verify(size, percent), "a long, b long"))


# ---------------------------------------------------------------- buckets

def buckets_of(signatures: DataFrame) -> DataFrame:
    """(``_bucket``, ``_band``, ``_least``, ``_node``, ``_n``) of every member but
    the smallest of each bucket with several."""
    spark = signatures.sparkSession
    posts = signatures.select("_node", "_n", F.posexplode("_bands").alias("_band", "_bucket"))
    least = posts.groupBy("_bucket").agg(F.min("_node").alias("_least"), F.count(F.lit(1)).alias("_m")).filter("_m > 1")
    least = staged(spark, least.drop("_m"), "minhash-least")  # written: a hot bucket's rows can be split in the join
    return staged(spark, posts.join(least, "_bucket").filter("_node <> _least"), "minhash-buckets")


def open_blocks(members: DataFrame, roots: DataFrame, signatures: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row (``_block``, ``_band``, ``_members``) for each meeting of two blocks
    of a bucket that has members of several components: members of side 0 are
    those outside the largest component, members of side 1 all."""
    spark = members.sparkSession
    rooted = staged(spark, members.join(roots, F.col("_node") == F.col("node"), "left")
                    .select("_bucket", "_band", "_node", "_n", F.coalesce("root", "_node").alias("_root")), "minhash-rooted")
    by_root = rooted.groupBy("_bucket", "_root").agg(F.count(F.lit(1)).alias("_c"), F.sum("_n").alias("_s"))

    def blocks(rows, runs):
        return F.ceil(F.greatest(rows / block, runs / ELEMENTS)).cast("long")

    count, runs, top = F.col("_m"), F.col("_t"), F.col("_top")
    split = (by_root.groupBy("_bucket").agg(F.sum("_c").alias("_m"), F.sum("_s").alias("_t"),
                                            F.max(F.struct("_c", "_s", "_root")).alias("_top"))
             .filter(count > top["_c"])
             .select("_bucket", top["_root"].alias("_major"), blocks(count, runs).alias("_g"),
                     blocks(count - top["_c"], runs - top["_s"]).alias("_h")))
    split = staged(spark, split, "minhash-open")
    rows = rooted.join(split, "_bucket").join(signatures.select("_node", "_places", "_bands"), "_node")
    rows = staged(spark, rows.withColumn("_in_major", F.col("_root") == F.col("_major")), "minhash-open-rows")

    def numbers(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    def side(number):
        member = F.struct(F.lit(number).alias("_side"), "_node", "_root", "_in_major", "_n", "_places", "_bands")
        return F.xxhash64("_bucket", "_l", "_r").alias("_block"), "_band", member.alias("_one")

    left = (rows.filter(~F.col("_in_major")).withColumn("_l", F.pmod(F.xxhash64("_node"), "_h"))
            .withColumn("_r", numbers("_g")).select(*side(0)))
    right = (rows.withColumn("_r", F.pmod(F.xxhash64("_node", F.lit(1)), "_g"))
             .withColumn("_l", numbers("_h")).select(*side(1)))
    return left.union(right).groupBy("_block", "_band").agg(F.collect_list("_one").alias("_members"))  # some 2 * block


def pairs_of_block(nodes: np.ndarray, roots: np.ndarray, major: np.ndarray, sizes: np.ndarray, places: np.ndarray,
                   bands: np.ndarray, side: np.ndarray, band: int, percent: int,
                   miss: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(member, member, equal places) of the pairs between components that share
    no earlier bucket and that the posterior does not drop."""
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    none = np.zeros(0, dtype=np.int64)
    kept = [(none, none, none)]
    step = max(1, (1 << 20) // max(len(right), 1))
    for at in range(0, len(left), step):
        mine = left[at:at + step]
        n, m = sizes[mine][:, None], sizes[right][None]
        fit = ((roots[mine][:, None] != roots[right][None])
               & (major[right][None] | (nodes[mine][:, None] < nodes[right][None]))
               & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))
        for earlier in range(band):
            fit &= bands[mine, earlier][:, None] != bands[right, earlier][None]
        i, j = np.nonzero(fit)
        pair, equal = survivors(mine[i], right[j], places, places, percent, miss)
        kept.append((mine[i[pair]], right[j[pair]], equal))
    return tuple(np.concatenate(c) for c in zip(*kept))


def _pending(percent: int, miss: float):
    """One row for each block with pairs to verify, the pairs as byte columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("_members")
            flat = column.flatten()
            nodes, roots, sizes, side = (flat.field(c).to_numpy() for c in ("_node", "_root", "_n", "_side"))
            major = flat.field("_in_major").to_numpy(zero_copy_only=False)
            places, bands = _matrix(flat.field("_places")), np.asarray(flat.field("_bands").flatten()).reshape(len(nodes), -1)
            edges = np.asarray(column.offsets) - column.offsets[0].as_py()
            blocks, numbers = batch.column("_block").to_pylist(), batch.column("_band").to_pylist()
            for number, band, lo, hi in zip(blocks, numbers, edges[:-1], edges[1:]):
                s = slice(lo, hi)
                a, b, equal = pairs_of_block(nodes[s], roots[s], major[s], sizes[s], places[s], bands[s], side[s], band,
                                             percent, miss)
                if len(a):
                    order = np.argsort(-equal, kind="stable")
                    a, b = a[order], b[order]
                    packed = np.stack([nodes[s][a], nodes[s][b], roots[s][a], roots[s][b]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number]), pa.array([np.unique(packed[:2])]), pa.array([packed.tobytes()], type=pa.binary())],
                        names=["_block", "_nodes", "_pairs"])

    return run


def _settle(size: int, percent: int):
    """Verifies a block's pairs from the most similar on; (a, b) of those that
    join two components which the block has not joined yet."""

    def run(pending: pa.Table, texts: pa.Table) -> pa.Table:
        numbers, linked = {}, []
        sets = {n: elements(t, size, numbers) for n, t in zip(texts.column("_node").to_pylist(), texts.column("_text").to_pylist())}
        joined: dict = {}

        def root(x):
            while x in joined:
                x = joined[x]
            return x

        for raw in pending.column("_pairs").to_pylist():
            for a, b, root_a, root_b in np.frombuffer(raw, dtype=np.int64).reshape(4, -1).T.tolist():
                root_a, root_b = root(root_a), root(root_b)
                if root_a != root_b and alike(sets[a], sets[b], percent):
                    joined[max(root_a, root_b)] = min(root_a, root_b)
                    linked.append((a, b))
        return pa.table({"a": pa.array([a for a, _ in linked], type=pa.int64()), "b": pa.array([b for _, b in linked], type=pa.int64())})

    return run


# ---------------------------------------------------------------- the whole

def linked_texts(texts: DataFrame, size: int = SIZE, percent: int = PERCENT, miss: float = MISS,
                 block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(signatures with set sizes, (node, root) of every linked node) of texts
    (``_node``, ``_text``)."""
    spark = texts.sparkSession
    signatures = staged(spark, texts.select("_node", "_text").mapInArrow(
        _signatures(size), "_node long, _n long, _places binary, _bands array<long>"), "minhash-signatures")
    members = buckets_of(signatures)
    stars = members.select(F.col("_least").alias("a"), F.col("_node").alias("b")).distinct()
    stars = staged(spark, likely(stars, signatures, percent, miss), "minhash-likely")
    links = staged(spark, verified(stars, texts, size, percent), "minhash-links")
    roots = components(spark, links, "a", "b")
    pending = staged(spark, open_blocks(members, roots, signatures, block).mapInArrow(
        _pending(percent, miss), "_block long, _nodes array<long>, _pairs binary"), "minhash-pending")
    nodes = staged(spark, pending.select("_block", F.explode("_nodes").alias("_node")), "minhash-pending-nodes")
    bodies = nodes.join(texts_of(nodes.select("_node"), texts), "_node")
    more = staged(spark, pending.select("_block", "_pairs").groupBy("_block").cogroup(bodies.groupBy("_block"))
                  .applyInArrow(_settle(size, percent), "a long, b long"), "minhash-links")
    return signatures, roots if more.isEmpty() else components(spark, links.union(more), "a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                    percent: int = PERCENT, **limits) -> DataFrame:
    """(``_id``, ``_n`` set size, ``_component``) of every row: the smallest id
    reachable over links of at least ``percent`` percent similarity."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"), F.unhex(F.sha2(text, 256)).alias("_sha"))
    texts = rows.groupBy("_sha").agg(F.min("_id").alias("_least"), F.first("_text").alias("_text"))
    texts = staged(spark, texts.withColumn("_node", F.monotonically_increasing_id()), "minhash-texts")
    signatures, roots = linked_texts(texts, size, percent, **limits)
    rooted = (texts.select("_sha", "_least", "_node").join(signatures.select("_node", "_n"), "_node", "left")
              .join(roots, F.col("_node") == F.col("node"), "left")
              .select("_sha", "_least", "_n", F.coalesce("root", "_node").alias("_root")))
    rooted = staged(spark, rooted, "minhash-rooted-texts")
    least = staged(spark, rooted.groupBy("_root").agg(F.min("_least").alias("_component")), "minhash-least-ids")
    named = staged(spark, rooted.join(least, "_root").select("_sha", "_n", "_component"), "minhash-named")
    return (rows.select("_id", "_sha").join(named, "_sha")
            .select("_id", F.coalesce("_n", F.lit(0).cast("long")).alias("_n"),
                    F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_component")).alias("_component")))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select(
        F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id"),
        F.coalesce(F.col("_id") == F.col("_component"), F.lit(False)).alias("kept"))
