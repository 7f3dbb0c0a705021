"""Language-model scoring with a hashed maximum-entropy model.

The output alphabet has 1,024 symbols: the end of text, the most frequent
training words, and 16 buckets that share all other words: 12 bands by
frequency of the words known by number, 4 by hash for all further words. A symbol's
probability is factored into its class (32 classes) and its place in the class,
each a softmax over hashed features of the history: a bias, the word before
(n-gram of one), the two words before (n-gram of two) and the word before the
last (a skip). Words before count by their number among the 32,768 known ones in
the class softmax, by symbol elsewhere. A bucket's word then has its smoothed share of the bucket's
training count, so that the probabilities of all words, with one place for an
unseen word, add up to one.

Training reads every training text. Unigram counts are exact and cover all
training tokens: frequent words are counted in a bounded table per task, all
others are sharded by hash. The model takes ``ROUNDS`` rounds; in a round each
task goes over its part of that round's texts in mini-batches (Adagrad), and
the tasks' weight changes are averaged by token count, folded in two levels.
What is broadcast has a fixed size: 32,768 words and 4 MB of weights.

Defined results: null and empty texts are the single end token; null ids are
training rows; repeated rows each get their row; an empty table gives an
empty result; other columns are not read. A word is a 64-bit hash of its
bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import text as T
from ledgerline.llm.staging import documents, staged

END = np.uint64(0x5EED_0E0D_0000_0001)  # stands for the end of a text
HOT = 32_768          # words counted in tables and known to the tasks by number
BUCKETS = 16
CLASSES = PLACES = 32
SYMBOLS = CLASSES * PLACES
TOP = SYMBOLS - BUCKETS
BANDS = 12            # buckets of words known by number, by frequency; the others share all further words by hash
START = HOT + BUCKETS  # history before the first word
SLOT_BITS, MORE_SLOT_BITS = 19, 16
ROUNDS = 3
MINI_BATCH = 16_384
RATE = 0.15
CLASS_ROWS, PLACE_ROWS = 1 << 14, 1 << 14
BLOCKS = 48
SHARD_TOKENS = 4_000_000  # training tokens for each shard of the rare-word counts


# ---------------------------------------------------------------- vocabulary

def _slot(hashes: np.ndarray, table: int) -> np.ndarray:
    """Place of words in a slot table: each table goes by other bits."""
    if table == 0:
        return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    return (T.mix(hashes + np.uint64(table)) >> np.uint64(64 - MORE_SLOT_BITS)).astype(np.int64)


@dataclass
class Vocabulary:
    """Frequent words by number; number 0 is the end of text. They are found by slot
    tables: words whose slot is taken stand in the next table, so none is left out."""
    hashes: np.ndarray
    tables: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, by_count: np.ndarray) -> Vocabulary:
        """``by_count``: different hashes by falling count."""
        words = np.concatenate([[END], by_count[by_count != END]]).astype(np.uint64)
        left, tables = np.arange(len(words)), []
        while len(left):
            place = _slot(words[left], len(tables))
            place, first = np.unique(place, return_index=True)
            size = 1 << (MORE_SLOT_BITS if tables else SLOT_BITS)
            slots, numbers = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.uint16)
            slots[place], numbers[place] = words[left[first]], left[first]
            tables.append((slots, numbers))
            left = np.delete(left, first)
        return cls(words, tables)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """A number for each word: frequent words by number, others ``HOT`` plus bucket."""
        out = (HOT + bucket(hashes)).astype(np.uint16)
        left = np.arange(len(hashes))
        for k, (slots, numbers) in enumerate(self.tables):
            place = _slot(hashes[left], k)
            known = slots[place] == hashes[left]
            out[left[known]] = numbers[place[known]]
            left = left[~known]
        return out

    def symbols(self) -> np.ndarray:
        """Symbol of each number."""
        out = np.zeros(HOT + BUCKETS, dtype=np.int64)
        n = len(self.hashes)
        out[:n] = np.where(np.arange(n) < TOP, np.arange(n), TOP + band(np.arange(n)))
        out[HOT:] = TOP + np.arange(BUCKETS)
        return out


def band(number: np.ndarray) -> np.ndarray:
    """Bucket of a word known by number: bands of rank, each as much wider than the last."""
    steps = np.log(np.maximum(number, TOP) / TOP) / np.log(HOT / TOP)
    return np.minimum((steps * BANDS).astype(np.int64), BANDS - 1)


def bucket(hashes: np.ndarray) -> np.ndarray:
    """Bucket of a word without a number, by hash."""
    return BANDS + (hashes % np.uint64(BUCKETS - BANDS)).astype(np.int64)


def _tokens(x: T.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's lower-cased words and its end; first token of each text."""
    x = x.lower_ascii()
    starts, ends, first = x.words()
    words = x.span_hash(x.prefix(), starts, ends)
    return np.insert(words, first[1:], END), first + np.arange(x.rows + 1)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's words with their counts, without those under 1e-6 of its
    tokens (a word above that share of all texts is above it in some task);
    and its number of tokens under a null word."""
    words, counts, total = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), 0

    def merged(w, c):
        w, back = np.unique(w, return_inverse=True)
        return w, np.bincount(back, weights=c, minlength=len(w)).astype(np.int64)

    fresh: list = []
    waiting = 0
    for batch in batches:
        for _, _, x in T.chunks(batch.column("_text")):
            tokens, _ = _tokens(x)
            total += len(tokens)
            fresh.append(np.unique(tokens, return_counts=True))
            waiting += len(fresh[-1][0])
            if waiting > 500_000:
                words, counts = merged(np.concatenate([words, *[f[0] for f in fresh]]),
                                       np.concatenate([counts, *[f[1] for f in fresh]]))
                fresh, waiting = [], 0
                if len(words) > 1_000_000:  # lossy: only which words are in the table depends on it
                    keep = np.argpartition(-counts, 300_000)[:300_000]
                    words, counts = words[keep], counts[keep]
    words, counts = merged(np.concatenate([words, *[f[0] for f in fresh]]),
                           np.concatenate([counts, *[f[1] for f in fresh]]))
    keep = counts >= max(1, int(total * 1e-6))
    yield pa.RecordBatch.from_arrays(
        [pa.array([None, *words[keep].view(np.int64).tolist()], type=pa.int64()),
         pa.array([total, *counts[keep].tolist()], type=pa.int64())], names=["_word", "_n"])


def vocabulary(texts: DataFrame) -> tuple[Vocabulary, int]:
    """Frequent words of ``_text`` and the number of all tokens."""
    counts = texts.mapInArrow(_frequent, "_word long, _n long").groupBy("_word").agg(F.sum("_n").alias("_n"))
    top = counts.orderBy(F.col("_word").isNotNull(), F.desc("_n"), "_word").limit(HOT).collect()
    total = sum(r["_n"] for r in top if r["_word"] is None)
    words = np.array([r["_word"] for r in top if r["_word"] is not None], dtype=np.int64).view(np.uint64)
    return Vocabulary.of(words[:HOT - 1]), total


# ---------------------------------------------------------------- encoded texts

_ENCODED = ("_chunk long, _row int, _id long, _held boolean, n_tokens long, _ids binary, "
            "_shard int, _rows binary, _hashes binary")


def _encode(vocab: Vocabulary, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            chunk = part << 32 | number
            held = np.array(batch.column("_held").to_pylist(), dtype=bool)
            rare_rows, rare = [], []
            for lo, hi, x in T.chunks(batch.column("_text")):
                tokens, first = _tokens(x)
                ids = vocab.ids(tokens)
                at = np.flatnonzero(ids >= HOT)
                row = np.searchsorted(first, at, side="right") - 1 + lo
                rare_rows.append(row.astype(np.uint32) | held[row].astype(np.uint32) << np.uint32(31))
                rare.append(tokens[at])
                n, some = hi - lo, batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, chunk)), pa.array(np.arange(lo, hi, dtype=np.int32)), some.column("_id"),
                    some.column("_held"), pa.array(np.diff(first)),
                    pa.array([ids[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], type=pa.binary()),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
                    names=[c.split()[0] for c in _ENCODED.split(", ")])
            rows = np.concatenate(rare_rows) if rare else np.zeros(0, np.uint32)
            hashes = np.concatenate(rare) if rare else np.zeros(0, np.uint64)
            shard = ((hashes >> np.uint64(32)) % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            full = np.flatnonzero(np.diff(cuts))
            n = len(full)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, chunk)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()),
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(full.astype(np.int32)),
                pa.array([rows[order[cuts[s]:cuts[s + 1]]].tobytes() for s in full], type=pa.binary()),
                pa.array([hashes[order[cuts[s]:cuts[s + 1]]].tobytes() for s in full], type=pa.binary())],
                names=[c.split()[0] for c in _ENCODED.split(", ")])
    return run


_RARE = "_chunk long, _texts binary, _logs binary, _knowns binary, _words array<long>, _counts array<long>"


def _count_rare(table: pa.Table) -> pa.Table:
    """One shard: count its training words, then give each chunk, in one row, its
    texts' sums of log10(count + 1) and numbers of words that have a count; and, once,
    the numbers of words and of their tokens by bucket."""
    rows = [np.frombuffer(b, dtype=np.uint32) for b in table.column("_rows").to_pylist()]
    hashes = [np.frombuffer(b, dtype=np.uint64) for b in table.column("_hashes").to_pylist()]
    chunk = np.repeat(table.column("_chunk").to_numpy(), [len(r) for r in rows])
    row, word = np.concatenate(rows), np.concatenate(hashes)
    words, back = np.unique(word, return_inverse=True)
    counts = np.bincount(back, weights=(row >> 31) == 0, minlength=len(words)).astype(np.int64)
    value = np.log10(counts + 1.0)[back]
    known = (counts > 0)[back]
    text = (row & np.uint32(0x7FFFFFFF)).astype(np.int32)
    change = np.ones(len(row), dtype=bool)  # a chunk's texts come in order
    change[1:] = (chunk[1:] != chunk[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(change)
    logs, knowns = np.add.reduceat(value, first), np.add.reduceat(known.astype(np.int64), first)
    begin = np.flatnonzero(np.concatenate([[True], chunk[first][1:] != chunk[first][:-1]]))
    cuts = list(zip(begin.tolist(), [*begin[1:].tolist(), len(first)]))
    seen = counts > 0
    n_words = np.bincount(bucket(words[seen]), minlength=BUCKETS).astype(np.int64)
    n_tokens = np.bincount(bucket(words[seen]), weights=counts[seen], minlength=BUCKETS).astype(np.int64)
    texts = text[first]
    return pa.table({
        "_chunk": pa.array([*chunk[first][begin].tolist(), None], type=pa.int64()),
        "_texts": pa.array([*[texts[a:b].tobytes() for a, b in cuts], None], type=pa.binary()),
        "_logs": pa.array([*[logs[a:b].tobytes() for a, b in cuts], None], type=pa.binary()),
        "_knowns": pa.array([*[knowns[a:b].tobytes() for a, b in cuts], None], type=pa.binary()),
        "_words": pa.array([None] * len(cuts) + [n_words.tolist()], type=pa.list_(pa.int64())),
        "_counts": pa.array([None] * len(cuts) + [n_tokens.tolist()], type=pa.list_(pa.int64())),
    })


_PER_TEXT = "_chunk long, _row int, _log double, _known long"


def _per_text(table: pa.Table) -> pa.Table:
    """One chunk: each text's sums over all shards."""
    text, log, known = (np.concatenate([np.frombuffer(b, dtype=t) for b in table.column(c).to_pylist()])
                        for c, t in (("_texts", np.int32), ("_logs", np.float64), ("_knowns", np.int64)))
    different, back = np.unique(text, return_inverse=True)
    return pa.table({
        "_chunk": pa.array(np.full(len(different), table.column("_chunk")[0].as_py())), "_row": pa.array(different),
        "_log": pa.array(np.bincount(back, weights=log, minlength=len(different))),
        "_known": pa.array(np.bincount(back, weights=known, minlength=len(different)).astype(np.int64))})


def _count_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(HOT + BUCKETS, dtype=np.int64)
    for batch in batches:
        for x in T.chunks(batch.column("_ids")):
            counts += np.bincount(x[2].data.view(np.uint16), minlength=len(counts))
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["_word", "_n"])


@dataclass
class Counts:
    """Exact training counts: of the frequent words by number, and of all words
    of each bucket (tokens and different words)."""
    hot: np.ndarray
    bucket_tokens: np.ndarray
    bucket_words: np.ndarray
    total: int
    distinct: int


def _counts(spark: SparkSession, encoded: DataFrame, vocab: Vocabulary, rare: DataFrame) -> Counts:
    train = encoded.filter("_row is not null and not _held")
    hot = np.zeros(HOT + BUCKETS, dtype=np.int64)
    for r in train.select("_ids").mapInArrow(_count_hot, "_word long, _n long").groupBy("_word").agg(F.sum("_n").alias("_n")).collect():
        hot[r["_word"]] = r["_n"]
    hot = hot[:HOT]
    tokens, words = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    sums = (rare.filter("_chunk is null").select(F.posexplode(F.arrays_zip("_words", "_counts")).alias("_b", "_v"))
            .groupBy("_b").agg(F.sum("_v._words").alias("_w"), F.sum("_v._counts").alias("_c")))
    for r in sums.collect():
        words[r["_b"]], tokens[r["_b"]] = r["_w"], r["_c"]
    total, distinct = int(hot.sum() + tokens.sum()), int((hot > 0).sum() + words.sum())
    n = len(vocab.hashes)
    middle = np.arange(TOP, n)
    place = band(middle)
    tokens += np.bincount(place, weights=hot[middle], minlength=BUCKETS).astype(np.int64)
    words += np.bincount(place, weights=hot[middle] > 0, minlength=BUCKETS).astype(np.int64)
    return Counts(hot, tokens, words, total, distinct)


# ---------------------------------------------------------------- the model

def _rows_of(x: np.ndarray, size: int, salt: int) -> np.ndarray:
    return (T.mix(x.astype(np.uint64) * np.uint64(64) + np.uint64(salt)) % np.uint64(size)).astype(np.int64)


# rows of a feature's weights: parts of the tables for word before, word before that, both
_CLASS_PARTS = (0.5, 0.25, 0.25)
_PARTS = (0.25, 0.25, 0.5)


def _own_rows(number: np.ndarray, size: int, salt: int) -> np.ndarray:
    """A row of its own for each word of the alphabet and the start, hashed rows for other words."""
    out = TOP + 1 + _rows_of(number, size - TOP - 1, salt)
    out[:TOP] = number[:TOP]
    out[START] = TOP
    return out


class Features:
    """Row numbers of the features, by history, precomputed where they are few. The
    words before are known by number in the class softmax, by symbol in pairs and places."""

    def __init__(self):
        number = np.arange(START + 1)
        self.symbol = np.where(number < TOP, number, TOP + number % BUCKETS)
        self.symbol[START] = SYMBOLS
        self.near = _own_rows(number, int(CLASS_ROWS * _CLASS_PARTS[0]), 3)
        self.far = int(CLASS_ROWS * _CLASS_PARTS[0]) + _own_rows(number, int(CLASS_ROWS * _CLASS_PARTS[1]), 4)
        symbol = np.arange(SYMBOLS + 1)
        pair = symbol[:, None] * CLASSES + np.arange(CLASSES)[None, :]
        self.near_place = _rows_of(pair, int(PLACE_ROWS * _PARTS[0]), 1)
        self.far_place = int(PLACE_ROWS * _PARTS[0]) + _rows_of(pair, int(PLACE_ROWS * _PARTS[1]), 2)

    def of(self, one: np.ndarray, two: np.ndarray, group: np.ndarray):
        """Rows in the class table and in the place table of the words (by number)
        ``one`` and ``two`` before, for symbols of class ``group``."""
        near, far = self.near[one], self.far[two]
        one, two = self.symbol[one], self.symbol[two]
        both = (one * 2654435761 + two * 40503) & 0xFFFFFFFF
        both_class = 3 * CLASS_ROWS // 4 + ((both * 2246822519 & 0xFFFFFFFF) >> 20)
        both_place = PLACE_ROWS // 2 + (((both + group * 374761393) * 3266489917 & 0xFFFFFFFF) >> 19)
        return ((near, far, both_class),
                (self.near_place[one, group], self.far_place[two, group], both_place))


@dataclass
class Model:
    """Biases and hashed feature weights of the class and the place softmax."""
    class_bias: np.ndarray
    place_bias: np.ndarray
    class_rows: np.ndarray
    place_rows: np.ndarray

    @classmethod
    def unigram(cls, symbol_counts: np.ndarray) -> Model:
        """The model without history: biases from smoothed counts."""
        c = (symbol_counts + 0.5).reshape(CLASSES, PLACES)
        return cls(np.log(c.sum(axis=1) / c.sum()).astype(np.float32),
                   np.log(c / c.sum(axis=1, keepdims=True)).astype(np.float32),
                   np.zeros((CLASS_ROWS, CLASSES), np.float32), np.zeros((PLACE_ROWS, PLACES), np.float32))

    def copy(self) -> Model:
        return Model(*[a.copy() for a in self.arrays()])

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.class_bias, self.place_bias, self.class_rows, self.place_rows

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def plus(self, change: np.ndarray) -> Model:
        out, at = [], 0
        for a in self.arrays():
            out.append((a.ravel() + change[at:at + a.size]).astype(np.float32).reshape(a.shape))
            at += a.size
        return Model(*out)


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def _forward(m: Model, f: Features, one, two, symbol):
    group, place = symbol // PLACES, symbol % PLACES
    by_class, by_place = f.of(one, two, group)
    a = m.class_rows[by_class[0]]
    a += m.class_rows[by_class[1]]
    a += m.class_rows[by_class[2]]
    a += m.class_bias
    b = m.place_rows[by_place[0]]
    b += m.place_rows[by_place[1]]
    b += m.place_rows[by_place[2]]
    b += m.place_bias[group]
    return group, place, by_class, by_place, _softmax(a), _softmax(b)


def log10_probability(m: Model, f: Features, one, two, symbol) -> np.ndarray:
    out = np.empty(len(symbol))
    for lo in range(0, len(symbol), MINI_BATCH):
        s = slice(lo, lo + MINI_BATCH)
        group, place, _, _, a, b = _forward(m, f, one[s], two[s], symbol[s])
        at = np.arange(len(group))
        out[s] = np.log10(np.maximum(a[at, group], 1e-30)) + np.log10(np.maximum(b[at, place], 1e-30))
    return out


def _summed(rows: np.ndarray, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows and the sums of their gradients."""
    small = rows.astype(np.uint16)
    order = np.argsort(small, kind="stable")
    sorted_rows = small[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
    return sorted_rows[first].astype(np.int64), np.add.reduceat(gradient[order], first, axis=0)


class Trainer:
    """Adagrad on a task's own copy of the weights."""

    def __init__(self, model: Model):
        self.m, self.f = model.copy(), Features()
        self.square = [np.full(a.shape, 1.0, np.float32) for a in self.m.arrays()]

    def _step(self, k: int, rows, gradient) -> None:
        self.square[k][rows] += gradient * gradient
        self.m.arrays()[k][rows] -= RATE * gradient / np.sqrt(self.square[k][rows])

    def update(self, one, two, symbol) -> None:
        group, place, by_class, by_place, a, b = _forward(self.m, self.f, one, two, symbol)
        at = np.arange(len(group))
        a[at, group] -= 1
        b[at, place] -= 1
        self._step(0, slice(None), a.sum(axis=0))
        self._step(1, *_summed(group, b))
        for rows in by_class:
            self._step(2, *_summed(rows, a))
        for rows in by_place:
            self._step(3, *_summed(rows, b))


def histories(ids: np.ndarray, first: np.ndarray, symbols: np.ndarray):
    """Word numbers one and two places before, and symbols, of texts laid end to end."""
    symbol = symbols[ids]
    one = np.empty_like(symbol)
    two = np.empty_like(symbol)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    begin = first[:-1]
    one[begin] = START
    two[begin] = START
    second = begin + 1
    two[second[second < first[1:]]] = START
    return one, two, symbol


def _encoded_chunks(column: pa.Array):
    for lo, hi, x in T.chunks(column):
        yield lo, hi, x.data.view(np.uint16), x.offsets // 2


def _train(model: Model, symbols: np.ndarray):
    """A task's weighted weight change after its texts of the round, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        trainer, n = Trainer(model), 0
        left: list = []
        waiting = 0

        def flush():
            one, two, symbol = (np.concatenate(x) for x in zip(*left))
            for lo in range(0, len(symbol), MINI_BATCH):
                s = slice(lo, lo + MINI_BATCH)
                trainer.update(one[s], two[s], symbol[s])

        for batch in batches:
            for _, _, ids, first in _encoded_chunks(batch.column("_ids")):
                left.append(histories(ids, first, symbols))
                waiting += len(ids)
                n += len(ids)
                if waiting >= 4 * MINI_BATCH:
                    flush()
                    left, waiting = [], 0
        if left:
            flush()
        if n:
            change = trainer.m.flat() - model.flat()
            pieces = np.array_split(change.astype(np.float16), BLOCKS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(BLOCKS, dtype=np.int32)), pa.array(np.full(BLOCKS, part % 32, dtype=np.int32)),
                 pa.array(np.full(BLOCKS, float(n))), pa.array([p.tobytes() for p in pieces], type=pa.binary())],
                names=["_block", "_salt", "_weight", "_change"])

    return run


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted means of the changes of each block (and salt) of a partition, one
    array for each in memory."""
    sums: dict = {}
    for batch in batches:
        for b, s, w, c in zip(*[batch.column(k).to_pylist() for k in range(4)]):
            change = np.frombuffer(c, dtype=np.float16).astype(np.float32)
            have = sums.setdefault((b, s), [0.0, np.zeros(len(change), np.float32)])
            have[0] += w
            have[1] += (w * change).astype(np.float32)
    for (b, s), (w, total) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([b], type=pa.int32()), pa.array([s], type=pa.int32()), pa.array([w], type=pa.float64()),
             pa.array([(total / w).astype(np.float16).tobytes()], type=pa.binary())],
            names=["_block", "_salt", "_weight", "_change"])


def train(spark: SparkSession, encoded: DataFrame, symbols: np.ndarray, model: Model, rounds: int = ROUNDS) -> Model:
    schema = "_block int, _salt int, _weight double, _change binary"
    texts = encoded.filter("_row is not null and not _held")
    for r in range(rounds):
        mine = texts.filter(F.pmod(F.xxhash64("_chunk", "_row"), F.lit(rounds)) == r).select("_ids")
        parts = mine.mapInArrow(_train(model, symbols), schema)
        folded = parts.repartition(BLOCKS, "_block", "_salt").mapInArrow(_fold, schema)
        means = folded.withColumn("_salt", F.lit(0)).repartition(BLOCKS, "_block").mapInArrow(_fold, schema).collect()
        if means:
            pieces = [np.frombuffer(m["_change"], dtype=np.float16).astype(np.float32)
                      for m in sorted(means, key=lambda m: m["_block"])]
            model = model.plus(np.concatenate(pieces))
    return model


def _score(model: Model, symbols: np.ndarray, c: Counts):
    n = c.total + c.distinct + 1
    log_count = np.concatenate([np.log10(c.hot + 1.0), np.zeros(BUCKETS)])
    known = np.concatenate([c.hot > 0, np.zeros(BUCKETS, dtype=bool)])
    share = np.zeros(HOT + BUCKETS)  # of a bucket's word, besides rare words' own log10(count + 1)
    in_bucket = symbols >= TOP
    share[in_bucket] = log_count[in_bucket] - np.log10((c.bucket_tokens + c.bucket_words + 1)[symbols[in_bucket] - TOP])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Features()
        for batch in batches:
            for lo, hi, ids, first in _encoded_chunks(batch.column("_ids")):
                one, two, symbol = histories(ids, first, symbols)
                value = log10_probability(model, f, one, two, symbol) + share[ids]
                some = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(k) for k in ("_chunk", "_row", "_id", "_held", "n_tokens")],
                     pa.array(T.per_row(known[ids], first)),
                     pa.array(T.per_row(log_count[ids], first) - np.diff(first) * np.log10(n)),
                     pa.array(T.per_row(value, first))],
                    names=["_chunk", "_row", "_id", "_held", "n_tokens", "_hot_known", "_hot_base", "_hot_score"])
    return run


def score_texts(docs: DataFrame, held, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all texts by a model of those where the column ``held`` is false."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(held, F.lit(False)).alias("_held"),
                        F.coalesce(text_col, F.lit("")).alias("_text"))
    vocab, tokens = vocabulary(texts.filter("not _held").select("_text"))
    shards = max(8, tokens // SHARD_TOKENS)
    encoded = staged(spark, texts.mapInArrow(_encode(vocab, shards), _ENCODED), "encoded")
    rare = staged(spark, encoded.filter("_shard is not null").select("_chunk", "_shard", "_rows", "_hashes")
                  .groupBy("_shard").applyInArrow(_count_rare, _RARE), "rare-words")
    counts = _counts(spark, encoded, vocab, rare)
    symbols = vocab.symbols()
    by_symbol = np.zeros(SYMBOLS)
    top = min(TOP, len(vocab.hashes))
    by_symbol[:top] = counts.hot[:top]
    by_symbol[TOP:] = counts.bucket_tokens
    model = train(spark, encoded, symbols, Model.unigram(by_symbol))
    known = "_chunk long, _row int, _id long, _held boolean, n_tokens long, _hot_known long, _hot_base double, _hot_score double"
    rows = (encoded.filter("_row is not null").select("_chunk", "_row", "_id", "_held", "n_tokens", "_ids")
            .mapInArrow(_score(model, symbols, counts), known))
    per_text = (rare.filter("_chunk is not null").select("_chunk", "_texts", "_logs", "_knowns")
                .groupBy("_chunk").applyInArrow(_per_text, _PER_TEXT))
    log, zero = F.coalesce("_log", F.lit(0.0)), F.lit(0).cast("long")
    return (rows.join(per_text, ["_chunk", "_row"], "left")
            .select("_id", "_held", "n_tokens", (F.col("_hot_known") + F.coalesce("_known", zero)).alias("n_known"),
                    F.lit(counts.total).cast("long").alias("train_tokens"),
                    (F.col("_hot_base") + log).alias("base_score"), (F.col("_hot_score") + log).alias("score")))


def op4_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return score_texts(documents(spark, sf_dir), held).select(
        F.col("_id").alias("doc_id"), F.col("_held").alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")
