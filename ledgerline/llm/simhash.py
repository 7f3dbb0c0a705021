"""Near-duplicate documents by SimHash, linked through a byte-position index.

A fingerprint is the bitwise majority of the XXH64 (seed 42) of a text's word
shingles. Fingerprints at ``max_bits`` or fewer differing bits can differ in
at most that many of their eight byte positions, so a linked pair shares at
least ``8 - max_bits`` positional bytes. The index posts every distinct
fingerprint under its positional bytes. Lists of single bytes would each hold
1/256 of the corpus and pair up quadratically, so the index is keyed by
``8 - max_bits`` byte positions at once, one key for each choice of positions:
the pairs that meet under a key are exactly those whose tally of shared bytes
can reach the minimum. In a list, the shared bytes of a pair are tallied,
pairs below the minimum dropped and the rest verified by their differing bits.

A list's members differ only in ``max_bits`` bytes, so no list can hold more
than ``256**max_bits`` fingerprints, whatever the corpus. Lists give spanning
edges, never all pairs; components are found over distinct fingerprints, so
groups of copies cost one node.

Defined results: null and empty texts have fingerprint zero, which is linked
like any other; rows with a null id get a fingerprint, join components and
take the smallest id of theirs (null if there is none); repeated rows each get
their row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import text as T
from ledgerline.llm.components import components
from ledgerline.llm.staging import documents, staged

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SMALL_LIST = 48


def fingerprint_texts(x: T.Texts, shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit fingerprints of some texts."""
    x = x.lower_ascii()
    digest = xxhash.xxh64_intdigest
    hashes, counts = [], np.zeros(x.rows, dtype=np.int64)
    for i in range(x.rows):
        words = x.raw(i).split()  # bytes.split() cuts at \x20 and \x09-\x0D
        if not words:
            continue
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        n = max(len(words) - shingle + 1, 1)
        last = min(shingle, len(words)) - 1
        hashes += [digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[last:last + n].tolist())]
        counts[i] = n
    out = np.zeros(x.rows, dtype=np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(-1, 64)
        first = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        out[full] = np.packbits(ones * 2 > counts[full][:, None], axis=1).view(">u8").ravel()
    return out


def _text_key(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(``_id``, ``_key``, ``_fp``): each row's id, digest of its text, and fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [fingerprint_texts(x, shingle) for _, _, x in T.chunks(batch.column("_text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_key"),
                 pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64))],
                names=["_id", "_key", "_fp"])

    return (docs.select(F.col(id_col).cast("long").alias("_id"), _text_key(F.col(text_col)).alias("_key"),
                        F.coalesce(text_col, F.lit("")).alias("_text"))
            .mapInArrow(run, "_id long, _key binary, _fp long"))


def _settle(labels: np.ndarray, linked) -> np.ndarray:
    """Smallest label reachable, by repeated minima over linked members."""
    while True:
        new = linked(labels)
        if (new == labels).all():
            return labels
        labels = new


def link_lists(members: np.ndarray, sizes: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (fingerprint, smallest linked fingerprint) of some posting
    lists, laid end to end."""
    a, b = [], []
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for m in np.unique(sizes):
        if m < 2:
            continue
        if m <= SMALL_LIST:
            for at in np.array_split(first[sizes == m], max(1, int((sizes == m).sum() * m * m // 2_000_000))):
                block = np.sort(members[at[:, None] + np.arange(m)], axis=1)
                differ = block[:, :, None] ^ block[:, None, :]
                tally = (np.ascontiguousarray(differ).view(np.uint8).reshape(*differ.shape, 8) == 0).sum(axis=-1)
                link = (tally >= 8 - max_bits) & (np.bitwise_count(differ) <= max_bits)
                own = np.broadcast_to(np.arange(m), block.shape)
                label = _settle(own, lambda v: np.where(link, v[:, None, :], m).min(axis=2))
                row, col = np.nonzero(label != own)
                a.append(block[row, col])
                b.append(block[row, label[row, col]])
            continue
        for at in first[sizes == m]:
            one = np.unique(members[at:at + m])
            neighbours = []
            for flips in itertools.chain.from_iterable(
                    itertools.combinations(_varying(one), k) for k in range(1, max_bits + 1)):
                other = one ^ np.uint64(sum(1 << f for f in flips))
                place = np.minimum(np.searchsorted(one, other), len(one) - 1)
                hit = one[place] == other
                if hit.any():
                    neighbours.append((np.flatnonzero(hit), place[hit]))

            def step(v, neighbours=neighbours):
                v = v.copy()
                for mine, theirs in neighbours:
                    v[mine] = np.minimum(v[mine], v[theirs])
                return v

            label = _settle(np.arange(len(one)), step)
            moved = np.flatnonzero(label != np.arange(len(one)))
            a.append(one[moved])
            b.append(one[label[moved]])
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate(a or [none]), np.concatenate(b or [none])


def _varying(one: np.ndarray) -> list[int]:
    """Bit places in which the members of a list differ at all."""
    spread = int(np.bitwise_or.reduce(one ^ one[0]))
    return [i for i in range(64) if spread >> i & 1]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(``a``, ``b``) spanning edges between linked fingerprints of ``_fp``."""
    keys = []
    for number, dropped in enumerate(itertools.combinations(range(8), max_bits)):
        mask = sum(0xFF << (8 * p) for p in range(8) if p not in dropped)
        mask -= (mask >> 63) << 64
        keys.append(F.xxhash64(F.lit(number), F.col("_fp").bitwiseAND(F.lit(mask).cast("long"))))
    posts = distinct.select("_fp", F.explode(F.array(*keys)).alias("_post"))
    shared = posts.groupBy("_post").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_post")
    lists = posts.join(shared, "_post", "left_semi").groupBy("_post").agg(F.collect_list("_fp").alias("_fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            sizes = np.diff(np.asarray(column.offsets))
            a, b = link_lists(np.asarray(column.flatten()).view(np.uint64), sizes, max_bits)
            pairs = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, k].copy().view(np.int64)) for k in (0, 1)],
                                             names=["a", "b"])

    return lists.select("_fps").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(``_id``, ``_key`` digest of the text, ``_fp``, ``_root`` of the component,
    ``_component``: smallest id reachable over links)."""
    spark = docs.sparkSession
    rows = staged(spark, fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = rows.groupBy("_fp").agg(F.min("_id").alias("_least"))
    roots = components(spark, links(distinct.select("_fp"), max_bits), "a", "b")
    rooted = (distinct.join(roots, F.col("_fp") == F.col("node"), "left")
              .select("_fp", "_least", F.coalesce("root", "_fp").alias("_root")))
    rooted = staged(spark, rooted, "rooted-fingerprints")
    least = staged(spark, rooted.groupBy("_root").agg(F.min("_least").alias("_component")), "least-ids")
    named = staged(spark, rooted.join(least, "_root").select("_fp", "_root", "_component"), "named-fingerprints")
    return rows.join(named, "_fp").select("_id", "_key", "_fp", "_root", "_component")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, the columns of ``docs``: that with
    the smallest (id, digest of the text); null ids come last. Decided by row,
    so of the texts that share an id, or have none, each stays unless it is a
    near copy. Of rows with the same id and text (null and empty texts are the
    same) the one with the smallest row hash stays. Groups are reduced by
    grouped minima, combined before the shuffle; only such repeated rows are
    grouped with their columns."""
    found = staged(spark, near_duplicates(docs).select("_id", "_key", "_root"), "simhash-rows")
    first = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_key"))
    firsts = staged(spark, found.groupBy("_root").agg(first.alias("_first")), "simhash-firsts")
    is_first = F.col("_id").eqNullSafe(F.col("_first._id")) & (F.col("_key") == F.col("_first._key"))
    judged = found.join(firsts, "_root").select("_id", "_key", is_first.alias("_stays"))
    times = staged(spark, judged.groupBy("_id", "_key").agg(F.max("_stays").alias("_stays"), F.count(F.lit(1)).alias("_times")),
                   "simhash-verdicts")
    lost = times.filter("not _stays").select(F.col("_id").alias("_simhash_id"), F.col("_key").alias("_simhash_key"))
    again = times.filter("_stays and _times > 1").select(F.col("_id").alias("_simhash_id"), F.col("_key").alias("_simhash_key"))
    same = (docs["doc_id"].cast("long").eqNullSafe(F.col("_simhash_id"))) & (_text_key(docs["text"]) == F.col("_simhash_key"))
    once = docs.join(lost.union(again), same, "left_anti")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    least = F.min_by(row, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).alias("_simhash_row")
    several = (docs.join(again, same, "left_semi")
               .groupBy(F.col("doc_id").alias("_simhash_id"), _text_key(F.col("text")).alias("_simhash_key")).agg(least))
    return once.union(several.select(*[F.col(f"_simhash_row.`{c}`").alias(c) for c in docs.columns]))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select(
        F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_component").alias("component_id"))
