"""Substring removal: word windows that start earlier elsewhere, found through a
count-min prefilter.

A window is ``size`` consecutive words. Counting all windows would shuffle one
row for each word of the corpus, so the sketch counts a window under its
anchor: the ``GRAM``-word run with the smallest hash inside it. Equal windows
have equal anchors, so an anchor's count is never below that of any of its
windows, while neighbouring windows share it: about one word in eight is an
anchor.

1. One pass writes the documents as compressed blocks, bucketed by part (some
   blocks of one task, so that a part has a bounded size), with the anchors and the hash of the whole word sequence of
   every text. Later passes read the blocks in place: texts are never shuffled.
2. Each part builds a count-min sketch of its anchors, of a fixed width for each
   shard, and sends its cells with their counts (stopped at two). A shard adds the
   parts' sketches up and returns to each part its cells that reach two. An
   anchor is marked if all its cells do: the estimate is never too low, so no
   repeated window is lost.
3. A second pass emits the runs of neighbouring windows of marked anchors as
   one row each. Runs equal as a whole are settled first: all but the first (by id
   and start) go. Only the first ones of anchors with several different runs,
   and runs that repeat a window inside, are then split into windows, which
   are grouped by two independent 64-bit hashes of their words; runs and whole
   texts are compared by two as well. (One hash alone would make about n * n / 2**65
   different windows equal: millions of them at the 10**13 windows of 100 TB.)
4. A last pass cuts the words covered by a later window.

Documents with the same word sequence as one with a smaller id lose all words
if they have a window at all; they are settled by that sequence and emit no
windows. Hot runs, windows and copies are combined before the shuffle, and the
joins back to them are plain equi-joins that the adaptive planner splits.

Defined results: null texts have no words and stay null; a null id comes after
all others; of rows with the same id neither comes first, so a window is
removed only for a smaller id or, in the same id, a smaller start; texts of
fewer than ``size`` words are left alone; an empty table gives an empty result;
other columns pass through ``remove_repeats`` as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import text as T
from ledgerline.llm.staging import documents, staged, staged_by

SIZE = 20
GRAM = 7
DEPTH = 2                # rows of the sketch
CELL_BITS = 32           # a row of a shard has 2**32 cells; only those in use are kept and sent
SHARD_ANCHORS = 1_000_000
PART_CHUNKS = 64         # blocks of a part, of a mebibyte of text each
NULL_ID = 2**63 - 1
WHOLE = -1               # start of a removal that takes the whole text


# ---------------------------------------------------------------- windows and anchors

def _sliding(x: np.ndarray, size: int, op) -> np.ndarray:
    """Minima or maxima of all runs of ``size`` values."""
    done = 1
    while 2 * done <= size:
        x = op(x[:-done], x[done:])
        done *= 2
    return op(x[:len(x) - (size - done)], x[size - done:]) if size > done else x


def window_anchors(words: np.ndarray, first: np.ndarray, size: int = SIZE, gram: int | None = None):
    """Flags of the windows that lie in one text, the anchor hash of each
    window, and the flags and hashes of the runs that are an anchor of some window."""
    gram = min(GRAM, size) if gram is None else gram
    ok = T.inside(first, size)
    none = np.zeros(0, dtype=np.uint64)
    if not len(ok):
        return ok, none, np.zeros(0, dtype=bool), none
    grams = T.rolling(words, gram, seed=7)
    span = size - gram + 1
    anchor = _sliding(grams, span, np.minimum)
    # a run is an anchor if it equals the minimum of a window that holds it
    padded = np.zeros(len(anchor) + 2 * (span - 1), dtype=np.uint64)
    padded[span - 1:span - 1 + len(anchor)] = np.where(ok, anchor, np.uint64(0))
    used = _sliding(padded, span, np.maximum) == grams
    return ok, anchor, used, grams


def _words(x: T.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts of the words, their hashes, each text's first word."""
    starts, ends, first = x.words()
    return starts, x.span_hash(x.prefix(), starts, ends), first


def _second(words: np.ndarray) -> np.ndarray:
    """Other hashes of the same words, for the second hash of a run."""
    return T.mix(words ^ np.uint64(0xA0761D6478BD642F))


class _Spans:
    """Hashes of word runs of any length, by prefix sums."""

    def __init__(self, words: np.ndarray):
        self.total = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * T._powers(T._MULT, len(words)), out=self.total[1:])
        self.back = T._powers(T._MULT_INV, len(words) + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return T.mix((self.total[end] - self.total[start]) * self.back[start] + (end - start).astype(np.uint64))


# ---------------------------------------------------------------- 1. blocks

_BLOCK = ("_part long, _chunk int, _ids binary, _counts binary, _wholes binary, _wholes2 binary, _anchors binary, "
          "_rows binary")


def _blocks(text_at: int, size: int):
    """Chunks of rows (the last column is the id) as one row each."""
    per_part = PART_CHUNKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        part, chunk = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = batch.select(batch.schema.names[:-1])
            ids = batch.column(batch.num_columns - 1).to_numpy()
            for lo, hi, x in T.chunks(batch.column(text_at)):
                _, words, first = _words(x)
                _, _, used, grams = window_anchors(words, first, size)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                    out.write_batch(rows.slice(lo, hi - lo))
                values = (ids[lo:hi].tobytes(), np.diff(first).tobytes(),
                          _Spans(words).hash(first[:-1], first[1:]).tobytes(),
                          _Spans(_second(words)).hash(first[:-1], first[1:]).tobytes(), grams[used].tobytes(),
                          sink.getvalue().to_pybytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 20 | chunk // per_part], type=pa.int64()), pa.array([chunk], type=pa.int32()),
                     *[pa.array([v], type=pa.binary()) for v in values]],
                    names=_names(_BLOCK))
                chunk += 1
    return run


def _rows(block: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(block).read_next_batch()


def blocks_of(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns],
                         F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("_repeat_id"))
    made = source.mapInArrow(_blocks(docs.columns.index(text_col), size), _BLOCK)
    return staged_by(docs.sparkSession, made, "_part", "repeat-blocks")


_PLACE = "_part long, _chunk int, _row int, _id long, _n long, _whole long, _whole2 long"


def _places(size: int):
    """One row for each text of a block that has a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk, ids, counts, *wholes in zip(*[c.to_pylist() for c in batch.columns]):
                counts = np.frombuffer(counts, np.int64)
                row = np.flatnonzero(counts >= size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), part)), pa.array(np.full(len(row), chunk, dtype=np.int32)),
                     pa.array(row.astype(np.int32)), pa.array(np.frombuffer(ids, np.int64)[row]), pa.array(counts[row]),
                     *[pa.array(np.frombuffer(w, np.int64)[row]) for w in wholes]], names=_names(_PLACE))
    return run


def copies_of(blocks: DataFrame, size: int) -> DataFrame:
    """(``_part``, ``_chunk``, ``_row``) of the texts with the word sequence of one with a smaller id."""
    texts = blocks.select("_part", "_chunk", "_ids", "_counts", "_wholes", "_wholes2").mapInArrow(_places(size), _PLACE)
    texts = staged(blocks.sparkSession, texts, "repeat-texts")
    firsts = texts.groupBy("_whole", "_whole2", "_n").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_times"))
    firsts = staged(blocks.sparkSession, firsts.filter("_times > 1").drop("_times"), "repeat-first-texts")
    found = texts.join(firsts, ["_whole", "_whole2", "_n"]).filter("_id > _first")
    return staged(blocks.sparkSession, found.select("_part", "_chunk", "_row"), "repeat-copies")


# ---------------------------------------------------------------- 2. the sketch

_SKETCH = "_line int, _part long, _cells binary, _often binary"


def _places_in(hashes: np.ndarray, row: int, shards: int) -> np.ndarray:
    """Cell of each anchor in a row of the sketch: its shard above ``CELL_BITS`` bits inside it."""
    shard = (hashes >> np.uint64(20)) % np.uint64(shards)
    inside = T.mix(hashes + np.uint64(0x632BE59BD9B4E019 * (row + 1) % 2**64)) >> np.uint64(64 - CELL_BITS)
    return shard << np.uint64(CELL_BITS) | inside


def _sketch(shards: int):
    """The count-min sketch of each part's anchors, one row for each shard and row
    of the sketch (``_line``): the cells that are not zero, in order, and one bit for
    each, set if it counts more than one."""

    def flush(part, raw):
        hashes = np.frombuffer(b"".join(raw), dtype=np.uint64)
        lines, cells, often = [], [], []
        for row in range(DEPTH):
            place, counts = np.unique(_places_in(hashes, row, shards), return_counts=True)
            cuts = np.searchsorted(place >> np.uint64(CELL_BITS), np.arange(shards + 1, dtype=np.uint64))
            for shard in np.flatnonzero(np.diff(cuts)):
                some = slice(cuts[shard], cuts[shard + 1])
                lines.append(int(shard) * DEPTH + row)
                cells.append(place[some].astype(np.uint32).tobytes())
                often.append(np.packbits(counts[some] > 1).tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(lines, type=pa.int32()), pa.array([part] * len(lines), type=pa.int64()),
             pa.array(cells, type=pa.binary()), pa.array(often, type=pa.binary())],
            names=["_line", "_part", "_cells", "_often"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, raw, waiting = None, [], 0
        for batch in batches:
            for part, anchors in zip(batch.column("_part").to_pylist(), batch.column("_anchors").to_pylist()):
                if raw and (part != now or waiting > 32_000_000):
                    yield flush(now, raw)
                    raw, waiting = [], 0
                now = part
                raw.append(anchors)
                waiting += len(anchors)
        if raw:
            yield flush(now, raw)
    return run


def merge_sketches(table: pa.Table) -> pa.Table:
    """One line of one shard: add up the parts' sketches cell by cell (above two all
    counts are the same) and return to each part those of its cells that reach two."""
    parts = [np.frombuffer(b, dtype=np.uint32) for b in table.column("_cells").to_pylist()]
    often = [np.unpackbits(np.frombuffer(b, dtype=np.uint8))[:len(p)]
             for b, p in zip(table.column("_often").to_pylist(), parts)]
    cells, back = np.unique(np.concatenate(parts), return_inverse=True)
    twice = (np.bincount(back, weights=np.concatenate(often) + 1.0, minlength=len(cells)) >= 2)[back]
    ends = np.cumsum([len(p) for p in parts])
    found = [p[twice[e - len(p):e]].tobytes() for p, e in zip(parts, ends)]
    keep = pa.array([bool(f) for f in found], type=pa.bool_())
    return pa.table({"_part": table.column("_part").filter(keep), "_line": table.column("_line").filter(keep),
                     "_cells": pa.array([f for f in found if f], type=pa.binary())})


_MARK = "_part long, _line int, _cells binary"


def shards_of(blocks: DataFrame) -> int:
    """Shards of the sketch, by the number of anchors."""
    anchors = blocks.agg(F.sum(F.length("_anchors"))).first()[0] or 0
    return int(max(8, anchors // 8 // SHARD_ANCHORS))


def marks_of(blocks: DataFrame, shards: int) -> DataFrame:
    """(``_part``, ``_line``, ``_cells``): each part's cells that count two or more in the merged sketch."""
    return (blocks.select("_part", "_anchors").mapInArrow(_sketch(shards), _SKETCH)
            .groupBy("_line").applyInArrow(merge_sketches, _MARK))


class Marked:
    """What a part has of the merged sketch."""

    def __init__(self, lines: list, cells: list, shards: int):
        self.shards = shards
        self.rows = []
        for row in range(DEPTH):
            own = [np.frombuffer(c, dtype=np.uint32).astype(np.uint64) | np.uint64(line // DEPTH << CELL_BITS)
                   for line, c in zip(lines, cells) if c and line % DEPTH == row]
            self.rows.append(np.unique(np.concatenate(own)) if own else np.zeros(0, dtype=np.uint64))

    def __bool__(self) -> bool:
        return all(len(r) for r in self.rows)

    def has(self, anchors: np.ndarray) -> np.ndarray:
        """Flags of the anchors whose estimate, the smallest of their ``DEPTH`` cells, is two or more."""
        change = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
        out = np.ones(len(change), dtype=bool)
        for row, cells in enumerate(self.rows):
            place = _places_in(anchors[change], row, self.shards)
            at = np.minimum(np.searchsorted(cells, place), len(cells) - 1)
            out &= cells[at] == place
        return np.repeat(out, np.diff(np.append(change, len(anchors))))


# ---------------------------------------------------------------- 3. runs and windows

_RUN = ("_part long, _chunk int, _row int, _id long, _start int, _windows int, _anchor long, _run long, _run2 long, "
        "_self boolean")


def _grouped(table: pa.Table, *columns: str) -> dict[int, list[np.ndarray]]:
    """Columns of a table's rows by their ``_chunk``, without rows of none."""
    table = table.select(["_chunk", *columns])
    table = table.filter(table.column("_chunk").is_valid())
    chunk = table.column("_chunk").to_numpy()
    order = np.argsort(chunk, kind="stable")
    values = [table.column(c).to_numpy()[order].astype(np.int64) for c in columns]
    cuts = np.flatnonzero(np.concatenate([[True], chunk[order][1:] != chunk[order][:-1]])) if len(chunk) else []
    ends = [*cuts[1:], len(chunk)]
    return {int(chunk[order[a]]): [v[a:b] for v in values] for a, b in zip(cuts, ends)}


def _runs(text_at: int, size: int, shards: int):
    """One part's blocks and marks: runs of neighbouring windows of a marked anchor."""

    def run(blocks: pa.Table, marks: pa.Table) -> pa.Table:
        marked = Marked(marks.column("_line").to_pylist(), marks.column("_cells").to_pylist(), shards)
        copied = _grouped(marks, "_row")
        parts = []
        for part, chunk, ids, raw in zip(*[blocks.column(c).to_pylist() for c in ("_part", "_chunk", "_ids", "_rows")]):
            if not marked:
                break
            x = T.column_bytes(_rows(raw).column(text_at))
            _, words, first = _words(x)
            ok, anchor, _, _ = window_anchors(words, first, size)
            if not len(ok):
                continue
            for row in copied.get(chunk, [()])[0]:
                ok[first[row]:first[row + 1]] = False
            hit = ok & marked.has(anchor)
            begin = hit.copy()
            begin[1:] &= ~(hit[:-1] & (anchor[1:] == anchor[:-1]))
            at = np.flatnonzero(begin)
            if not len(at):
                continue
            number = np.cumsum(begin) - 1
            inner = np.flatnonzero(hit)
            count = np.bincount(number[inner], minlength=len(at))
            keys = T.mix(T.rolling(words, size, seed=11)[inner] + T.mix(number[inner].astype(np.uint64) + np.uint64(1)))
            _, once = np.unique(keys, return_index=True)
            different = np.bincount(number[inner[once]], minlength=len(at))
            row = np.searchsorted(first, at, side="right") - 1
            parts.append(pa.table([
                pa.array(np.full(len(at), part)), pa.array(np.full(len(at), chunk, dtype=np.int32)),
                pa.array(row.astype(np.int32)), pa.array(np.frombuffer(ids, np.int64)[row]),
                pa.array((at - first[row]).astype(np.int32)), pa.array(count.astype(np.int32)),
                pa.array(anchor[at].view(np.int64)),
                *[pa.array(_Spans(w).hash(at, at + count + size - 1).view(np.int64)) for w in (words, _second(words))],
                pa.array(different < count)], names=_names(_RUN)))
        return pa.concat_tables(parts) if parts else _empty(_RUN)
    return run


_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _empty(schema: str) -> pa.Table:
    return pa.table({c.split()[0]: pa.nulls(0, _ARROW[c.split()[1]]) for c in schema.split(", ")})


_WINDOW = "_part long, _chunk int, _row int, _id long, _start int, _window long, _window2 long"


def _split(text_at: int, size: int):
    """One part's blocks and runs: the single windows of the runs."""

    def run(blocks: pa.Table, runs: pa.Table) -> pa.Table:
        wanted = _grouped(runs, "_row", "_id", "_start", "_windows")
        parts = []
        for part, chunk, raw in zip(*[blocks.column(c).to_pylist() for c in ("_part", "_chunk", "_rows")]):
            if chunk not in wanted:
                continue
            _, words, first = _words(T.column_bytes(_rows(raw).column(text_at)))
            hashes = [T.rolling(w, size, seed=11) for w in (words, _second(words))]
            row, ids, start, count = wanted[chunk]
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            row, ids, start = np.repeat(row, count), np.repeat(ids, count), np.repeat(start, count) + step
            parts.append(pa.table([
                pa.array(np.full(len(row), part)), pa.array(np.full(len(row), chunk, dtype=np.int32)),
                pa.array(row.astype(np.int32)), pa.array(ids), pa.array(start.astype(np.int32)),
                *[pa.array(h[first[row] + start].view(np.int64)) for h in hashes]], names=_names(_WINDOW)))
        return pa.concat_tables(parts) if parts else _empty(_WINDOW)
    return run


def _later(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` whose key (two hashes) occurs with a smaller id or, in the same id, a smaller
    start. The firsts are written before the join: a join straight on top of the
    grouping would keep all rows of a hot key in one task."""
    first = rows.groupBy(*key).agg(F.min(F.struct("_id", "_start")).alias("_e"), F.count(F.lit(1)).alias("_times"))
    first = staged(rows.sparkSession, first.filter("_times > 1").drop("_times"), "repeat-firsts")
    joined = rows.join(first, key)
    return joined.filter("_id > _e._id or (_id = _e._id and _start > _e._start)")


def removals_of(blocks: DataFrame, copies: DataFrame, text_at: int, size: int) -> DataFrame:
    """(``_part``, ``_chunk``, ``_row``, ``_start``, ``_windows``): runs of windows
    that start earlier elsewhere; start ``WHOLE`` for a text that is a copy."""
    spark = blocks.sparkSession
    none = F.lit(None)
    shards = shards_of(blocks)
    marks = marks_of(blocks, shards).select(
        "_part", none.cast("int").alias("_chunk"), none.cast("int").alias("_row"), "_line", "_cells").union(
        copies.select("_part", "_chunk", "_row", none.cast("int"), none.cast("binary")))
    texts = blocks.select("_part", "_chunk", "_ids", "_rows")
    runs = staged(spark, texts.groupBy("_part").cogroup(marks.groupBy("_part")).applyInArrow(_runs(text_at, size, shards), _RUN),
                  "repeat-runs")
    place = ["_part", "_chunk", "_row", "_start", "_windows"]
    known = staged(spark, _later(runs.drop("_anchor", "_self"), ["_run", "_run2"]).select(*place), "repeat-later")
    leaders = runs.join(known.select("_part", "_chunk", "_row", "_start"), ["_part", "_chunk", "_row", "_start"], "left_anti")
    several = (leaders.groupBy("_anchor").agg(F.min(F.struct("_run", "_run2")).alias("_a"),
                                           F.max(F.struct("_run", "_run2")).alias("_b"))
               .filter("_a <> _b").select("_anchor"))
    several = staged(spark, several, "repeat-several")  # written, so that the rows of a common anchor can be split
    split = leaders.filter("not _self").join(several, "_anchor", "left_semi").select(*place, "_id").union(
        leaders.filter("_self").select(*place, "_id"))
    windows = staged(spark, texts.groupBy("_part").cogroup(split.groupBy("_part")).applyInArrow(_split(text_at, size), _WINDOW),
                     "repeat-windows")
    later = _later(windows, ["_window", "_window2"]).select(
        "_part", "_chunk", "_row", "_start", F.lit(1).alias("_windows"))
    return known.union(later).union(
        copies.select("_part", "_chunk", "_row", F.lit(WHOLE).alias("_start"), F.lit(0).alias("_windows")))


# ---------------------------------------------------------------- 4. cutting

def _gone(first: np.ndarray, removals: list[np.ndarray] | None, size: int) -> np.ndarray:
    """Flags of the words that are removed from the texts of a block."""
    n = int(first[-1])
    gone = np.zeros(n, dtype=bool)
    if removals:
        row, start, count = removals
        whole = start == WHOLE
        begin = np.where(whole, first[row], first[row] + start)
        end = np.where(whole, first[row + 1], begin + count + size - 1)
        change = np.zeros(n + 1, dtype=np.int64)
        np.add.at(change, begin, 1)
        np.add.at(change, end, -1)
        gone = np.cumsum(change[:n]) > 0
    return gone


def _kept_text(x: T.Texts, word_starts: np.ndarray, first: np.ndarray, gone: np.ndarray) -> list[bytes]:
    """Texts without the removed words and the blanks after each."""
    drop = np.zeros(len(x.data) + 1, dtype=np.int32)
    row = np.searchsorted(first, np.flatnonzero(gone), side="right") - 1
    until = np.concatenate([word_starts[1:], [len(x.data)]])[gone]
    until = np.minimum(until, x.offsets[row + 1])
    np.add.at(drop, word_starts[gone], 1)
    np.add.at(drop, until, -1)
    keep = np.cumsum(drop[:-1]) == 0
    return [x.data[a:b][keep[a:b]].tobytes() for a, b in zip(x.offsets[:-1], x.offsets[1:])]


def _cut(text_at: int, size: int, make):
    """One part's blocks and removals: ``make(rows, ids, texts, first word of each text,
    removed words, kept texts)`` of each block."""

    def run(blocks: pa.Table, removals: pa.Table) -> pa.Table:
        by_chunk = _grouped(removals, "_row", "_start", "_windows")
        out = []
        for chunk, ids, raw in zip(*[blocks.column(c).to_pylist() for c in ("_chunk", "_ids", "_rows")]):
            rows = _rows(raw)
            x = T.column_bytes(rows.column(text_at))
            starts, _, first = x.words()
            gone = _gone(first, by_chunk.get(chunk), size)
            out.append(make(rows, np.frombuffer(ids, np.int64), x, first, gone, _kept_text(x, starts, first, gone)))
        return pa.concat_tables(out)
    return run


def _apply(docs: DataFrame, id_col: str, text_col: str, size: int, make, schema) -> DataFrame:
    text_at = docs.columns.index(text_col)
    blocks = blocks_of(docs, id_col, text_col, size)
    removals = removals_of(blocks, copies_of(blocks, size), text_at, size)
    return (blocks.select("_part", "_chunk", "_ids", "_rows").groupBy("_part").cogroup(removals.groupBy("_part"))
            .applyInArrow(_cut(text_at, size, make), schema))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                   length_col: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated words cut out of their texts; a null text stays
    null, and a ``length_col`` is brought up to date where a text changes."""

    def make(rows, ids, x, first, gone, kept):
        changed = T.per_row(gone, first) > 0
        old = rows.column(text_col).to_pylist()
        texts = [k.decode() if c else o for k, c, o in zip(kept, changed, old)]
        columns = list(rows.columns)
        at = rows.schema.get_field_index(text_col)
        columns[at] = pa.array(texts, type=rows.schema.field(at).type)
        at = rows.schema.get_field_index(length_col)
        if at >= 0:
            columns[at] = pa.array([len(t) if c else o for t, c, o in zip(texts, changed, columns[at].to_pylist())],
                                   type=rows.schema.field(at).type)
        return pa.Table.from_arrays(columns, names=rows.schema.names)

    return _apply(docs, id_col, text_col, size, make, docs.schema)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """Per document: words, removed words, digest of the kept words."""

    def make(rows, ids, x, first, gone, kept):
        return pa.table({
            "_id": pa.array(ids, mask=ids == NULL_ID), "n_words": pa.array(np.diff(first)),
            "n_removed": pa.array(T.per_row(gone, first)),
            "kept_sha256": pa.array([hashlib.sha256(b" ".join(k.split())).hexdigest() for k in kept], type=pa.string())})

    return _apply(docs.select(id_col, text_col), id_col, text_col, size, make,
                  "_id long, n_words long, n_removed long, kept_sha256 string")


def remove_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir)).withColumnRenamed("_id", "doc_id")
