"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A merge only ever builds vocabulary tokens, so two adjacent bytes that occur
together inside no token can never end up in one token: each such byte pair is
a certain cut. Texts are cut there and where the tokenizer's word pattern cuts
them; the fragments are encoded independently, each different one once, and
the results laid end to end. Everything works on whole chunks of texts in
numpy: cuts are table look-ups, and the merges of all new fragments of a chunk
are applied together, the lowest rank of every fragment in each step.

The vocabulary file is a parameter; its content travels with the job. Special
tokens of the file found in a text get their own id, as the library does.

Defined results: null and empty texts have no tokens; null ids stay null;
repeated rows each get their row; an empty table gives an empty result; other
columns are not read. Fragments are cached by a 64-bit hash of their bytes.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import text as T
from ledgerline.llm.staging import documents

NONE = np.int32(2**31 - 1)
CACHE_ENTRIES = 3_000_000
SPACE, LETTER, NUMBER, OTHER, UNSEEN = 0, 1, 2, 3, 9


def vocabulary_file(path: str | None = None) -> bytes:
    """The tokenizer file's content; by default that of the public 50k vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, "rb") as f:
        return f.read()


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable
    bytes stand for themselves, the others for the letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """Tables of one vocabulary, and the fragments encoded so far by this worker."""

    def __init__(self, spec: bytes):
        from tokenizers.pre_tokenizers import ByteLevel

        made = json.loads(spec)
        letters = _byte_letters()
        tokens = {i: bytes(letters[c] for c in t) for t, i in made["model"]["vocab"].items()}
        ids = {b: i for i, b in tokens.items()}
        self.special = {a["content"].encode(): a["id"] for a in made["added_tokens"]}
        tokens |= {i: b for b, i in self.special.items()}
        size = max(tokens) + 1
        self.token_lengths = np.array([len(tokens.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.token_starts = np.concatenate([[0], np.cumsum(self.token_lengths)[:-1]])
        self.token_bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)), dtype=np.uint8)
        self.byte_ids = np.array([ids[bytes([b])] for b in range(256)], dtype=np.int64)
        inside = np.zeros((256, 256), dtype=bool)
        for b in ids:
            pair = np.frombuffer(b, dtype=np.uint8)
            inside[pair[:-1], pair[1:]] = True
        self.forced = ~inside.ravel()
        self._merge_table(made["model"]["merges"], letters, ids)
        self.classes = np.full(0x110000, UNSEEN, dtype=np.uint8)
        self.words = ByteLevel(add_prefix_space=False, use_regex=True)
        self._learn_classes(np.arange(128))
        self.known = np.zeros(0, dtype=np.uint64)
        self.starts, self.lengths = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint16 if size <= 65536 else np.uint32)

    # ------------------------------------------------------------ merges

    def _merge_table(self, merges: list, letters: dict, ids: dict) -> None:
        """Two tables in which every pair of token ids has one place in one of them."""
        self.table_bits = 17
        self.pair = np.full(2 << self.table_bits, -1, dtype=np.int64)
        self.rank = np.full(2 << self.table_bits, NONE, dtype=np.int32)
        self.made = np.zeros(2 << self.table_bits, dtype=np.int64)
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            left, right = (bytes(letters[c] for c in t) for t in (left, right))
            entry, side = (ids[left] << 32 | ids[right], rank, ids[left + right]), 0
            for _ in range(500):
                at = int(self._places(np.array([entry[0]]))[side][0])
                held = (int(self.pair[at]), int(self.rank[at]), int(self.made[at]))
                self.pair[at], self.rank[at], self.made[at] = entry
                if held[0] < 0:
                    break
                entry, side = held, 1 - (at >> self.table_bits)
            else:
                raise ValueError("the merge table is too small for this vocabulary")

    def _places(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = T.mix(pairs.astype(np.uint64))
        mask = np.uint64((1 << self.table_bits) - 1)
        return ((h & mask).astype(np.int64),
                ((h >> np.uint64(32)) & mask).astype(np.int64) + (1 << self.table_bits))

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging each pair; rank ``NONE`` where there is none."""
        pairs = left << 32 | right
        one, two = self._places(pairs)
        at = np.where(self.pair[one] == pairs, one, two)
        return np.where(self.pair[at] == pairs, self.rank[at], NONE), self.made[at]

    def merge(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some fragments laid end to end, and how many each has."""
        symbols = self.byte_ids[data]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        done_ids, done_owner = [], []
        rank, made = np.full(len(symbols), NONE), np.zeros(len(symbols), dtype=np.int64)
        same = np.flatnonzero(owner[:-1] == owner[1:])
        rank[same], made[same] = self._look_up(symbols[same], symbols[same + 1])
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            count = np.diff(np.concatenate([first, [len(owner)]]))
            least = np.minimum.reduceat(rank, first)
            over = least == NONE
            if over.any():
                out = np.repeat(over, count)
                done_ids.append(symbols[out])
                done_owner.append(owner[out])
                keep = ~out
                symbols, owner, rank, made = symbols[keep], owner[keep], rank[keep], made[keep]
                count, least = count[~over], least[~over]
                if not len(symbols):
                    break
            hit = rank == np.repeat(least, count)
            run = hit.copy()
            run[1:] &= ~hit[:-1]
            if run.sum() != hit.sum():  # a run of one symbol: every other pair, from the left
                place = np.arange(len(hit))
                since = place - np.maximum.accumulate(np.where(run, place, 0))
                hit &= since % 2 == 0
            at = np.flatnonzero(hit)
            symbols[at] = made[at]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            now = at - np.arange(len(at))  # each merge before it took one place
            symbols, owner, rank, made = symbols[keep], owner[keep], rank[keep], made[keep]
            changed = np.unique(np.concatenate([now, now[now > 0] - 1]))
            rank[changed] = NONE
            pairs = changed[changed + 1 < len(owner)]
            pairs = pairs[owner[pairs] == owner[pairs + 1]]
            rank[pairs], made[pairs] = self._look_up(symbols[pairs], symbols[pairs + 1])
        if not done_ids:
            return symbols, np.zeros(len(lengths), dtype=np.int64)
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(done_ids)[order], np.bincount(owner, minlength=len(lengths))

    # ------------------------------------------------------------ cuts

    def _learn_classes(self, codes: np.ndarray) -> None:
        """Classes of some code points, as the library's word pattern has them."""
        for c in codes.tolist():
            if 0xD800 <= c < 0xE000:
                continue
            joined = [len(self.words.pre_tokenize_str(lead + chr(c))) == 1 for lead in ("a", "1", "!")]
            self.classes[c] = LETTER if joined[0] else NUMBER if joined[1] else OTHER if joined[2] else SPACE

    def _code_points(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        lead = data[at].astype(np.int64)
        codes = lead.copy()
        for size, low, high, bits in ((2, 0xC0, 0xE0, 0x1F), (3, 0xE0, 0xF0, 0x0F), (4, 0xF0, 0x100, 0x07)):
            these = np.flatnonzero((lead >= low) & (lead < high))
            value = lead[these] & bits
            for k in range(1, size):
                value = value << 6 | (data[np.minimum(at[these] + k, len(data) - 1)] & 0x3F)
            codes[these] = value
        return np.minimum(codes, 0x10FFFF)

    def cuts(self, x: T.Texts) -> np.ndarray:
        """Byte places at which fragments begin."""
        data, n = x.data, len(x.data)
        if not n:
            return np.zeros(0, dtype=np.int64)
        edges, special = x.offsets, []
        for content in self.special:
            raw, at = data.tobytes(), -1
            while (at := raw.find(content, at + 1)) >= 0:
                row = np.searchsorted(x.offsets, at, side="right")
                if at + len(content) <= x.offsets[row]:  # not across two texts
                    special.append((at, at + len(content)))
        if special:
            edges = np.unique(np.concatenate([edges, np.array(special).ravel()]))
        at = np.flatnonzero((data & 0xC0) != 0x80)
        kind = self.classes[data[at]] if (data < 128).all() else None
        if kind is None:
            codes = self._code_points(data, at)
            kind = self.classes[codes]
            if (kind == UNSEEN).any():
                self._learn_classes(np.unique(codes[kind == UNSEEN]))
                kind = self.classes[codes]
        m = len(at)
        byte = data[at]
        begins = np.zeros(m + 1, dtype=bool)
        begins[np.searchsorted(at, edges)] = True
        begins[m] = True
        blank = byte == 32
        fresh = begins[:m].copy()
        fresh[1:] |= kind[1:] != kind[:-1]
        attached = np.zeros(m, dtype=bool)  # a blank before the run belongs to it
        attached[1:] = blank[:-1] & (kind[1:] != SPACE) & ~begins[1:m]
        start = fresh & ~attached
        before_word = np.zeros(m, dtype=bool)  # the last white space before a word stands alone or goes with it
        before_word[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begins[1:m]
        start |= before_word
        for p in np.flatnonzero(start & (byte == 39)).tolist():
            tail = bytes(byte[p + 1:p + 3].tolist())
            size = 2 if tail in (b"re", b"ve", b"ll") else 1 if tail[:1] in (b"s", b"t", b"m", b"d") else 0
            if size and not begins[p + 1:p + 1 + size].any():
                start[p + 1:p + 1 + size] = False
                if p + 1 + size < m:
                    start[p + 1 + size] = True
        cut = np.zeros(n, dtype=bool)
        cut[at[start]] = True
        cut[1:] |= self.forced[data[:-1].astype(np.int64) << 8 | data[1:]]
        for a, b in special:
            cut[a:b] = False
            cut[a] = True
        return np.flatnonzero(cut)

    # ------------------------------------------------------------ texts

    def _fragment_numbers(self, x: T.Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The place of each fragment in this worker's cache; new ones are encoded."""
        hashes = x.span_hash(x.prefix(), starts, ends)
        different, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, different)
        found = np.zeros(len(different), dtype=bool)
        inner = place < len(self.known)
        found[inner] = self.known[place[inner]] == different[inner]
        if not found.all():
            new = np.flatnonzero(~found)
            a, b = starts[first[new]], ends[first[new]]
            lengths = b - a
            data = x.data[np.repeat(a - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())]
            ids, counts = self.merge(data, lengths)
            whole = np.flatnonzero(np.isin(lengths, [len(c) for c in self.special]))
            own = {i: self.special[raw] for i in whole.tolist()
                   if (raw := x.data[a[i]:b[i]].tobytes()) in self.special}
            if own:
                parts = np.split(ids, np.cumsum(counts)[:-1])
                for i, token in own.items():
                    parts[i], counts[i] = np.array([token]), 1
                ids = np.concatenate(parts)
            if len(self.known) + len(new) > CACHE_ENTRIES:
                keep = np.zeros(len(self.known), dtype=bool)
                keep[place[found]] = True  # what this chunk uses stays
                self._shrink(keep)
                place = np.searchsorted(self.known, different)
            added = len(self.flat) + np.concatenate([[0], np.cumsum(counts)[:-1]])
            self.flat = np.concatenate([self.flat, ids.astype(self.flat.dtype)])
            self.known = np.insert(self.known, place[new], different[new])
            self.starts = np.insert(self.starts, place[new], added)
            self.lengths = np.insert(self.lengths, place[new], counts)
            place = np.searchsorted(self.known, different)
        return place[back]

    def _shrink(self, keep: np.ndarray) -> None:
        starts, lengths = self.starts[keep], self.lengths[keep]
        self.flat = self.flat[_spread(starts, lengths)]
        self.known, self.lengths = self.known[keep], lengths
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)

    def encode(self, x: T.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts laid end to end, and each text's first one."""
        starts = self.cuts(x)
        if not len(starts):
            return np.zeros(0, dtype=self.flat.dtype), np.zeros(x.rows + 1, dtype=np.int64)
        ends = np.concatenate([starts[1:], [len(x.data)]])
        number = self._fragment_numbers(x, starts, ends)
        lengths = self.lengths[number]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return self.flat[_spread(self.starts[number], lengths)], total[np.searchsorted(starts, x.offsets)]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> T.Texts:
        """The bytes of some id sequences laid end to end."""
        lengths = self.token_lengths[ids]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return T.Texts(self.token_bytes[_spread(self.token_starts[ids], lengths)], total[first])


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all items of some runs."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


_CODECS: dict[bytes, Codec] = {}


def codec(spec: bytes) -> Codec:
    key = hashlib.sha256(spec).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(spec)
    return _CODECS[key]


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(``_id``, ``_ids``): the token ids of every text as little-endian unsigned
    32-bit integers."""
    spec = vocabulary_file(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec)
        for batch in batches:
            for lo, hi, x in T.chunks(batch.column("_text")):
                ids, first = own.encode(x)
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(lo, hi - lo),
                     pa.array([raw[4 * a:4 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())], type=pa.binary())],
                    names=["_id", "_ids"])

    return (docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
            .mapInArrow(run, "_id long, _ids binary"))


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(``_id``, ``_text``) of what ``encode_documents`` gives."""
    spec = vocabulary_file(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec)
        for batch in batches:
            for lo, hi, x in T.chunks(batch.column("_ids")):
                back = own.decode(x.data.view("<u4").astype(np.int64), x.offsets // 4)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(lo, hi - lo),
                     pa.array([back.raw(i).decode("utf-8", "replace") for i in range(back.rows)], type=pa.string())],
                    names=["_id", "_text"])

    return encoded.select("_id", "_ids").mapInArrow(run, "_id long, _text string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Encode every text, decode its ids again, and return the count of ids and
    the digests of both, in one pass and without a shuffle."""
    spec = vocabulary_file(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec)
        sha = hashlib.sha256
        for batch in batches:
            for lo, hi, x in T.chunks(batch.column("_text")):
                ids, first = own.encode(x)
                back = own.decode(ids, first)
                raw, cut = ids.astype("<u4").tobytes(), (4 * first).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(lo, hi - lo), pa.array(np.diff(first)),
                     pa.array([sha(raw[a:b]).hexdigest() for a, b in zip(cut[:-1], cut[1:])], type=pa.string()),
                     pa.array([sha(back.raw(i).decode("utf-8", "replace").encode()).hexdigest()
                               for i in range(back.rows)], type=pa.string())],
                    names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
            .mapInArrow(run, "_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir)).withColumnRenamed("_id", "doc_id")
