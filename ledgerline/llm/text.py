"""Numpy helpers over Arrow text columns, shared by the Python-side operators.

Texts are handled as UTF-8 bytes in chunks of whole rows. A word is a maximal
run of bytes other than the ASCII blanks ``\\x20`` and ``\\x09``-``\\x0D``;
these bytes never occur inside a multi-byte character, so byte runs and
code-point runs are the same. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_MULT_INV = np.uint64(pow(int(_MULT), -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64; grown by doubling and kept for
    the worker's life up to one chunk, so a very long text does not pin memory."""
    have = _POWERS.get(int(base))
    if have is not None and len(have) >= n:
        return have[:n]
    size = max(n, CHUNK_BYTES + 1)
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    np.cumprod(out, out=out)
    if size <= 4 * CHUNK_BYTES:
        _POWERS[int(base)] = out
    return out[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser, so that every bit of a hash depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Texts:
    """Some whole rows of a text column: ``data`` bytes, row ``offsets``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.rows = len(offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def lower_ascii(self) -> Texts:
        """A copy with A-Z lower-cased and nothing else."""
        upper = (self.data >= 65) & (self.data <= 90)
        return Texts(np.where(upper, self.data | np.uint8(32), self.data), self.offsets)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of all words, and each row's first word
        (``rows + 1`` entries)."""
        n = len(self.data)
        if n == 0:
            none = np.zeros(0, dtype=np.int64)
            return none, none, np.zeros(self.rows + 1, dtype=np.int64)
        space = _SPACE[self.data]
        before = np.empty(n, dtype=bool)
        before[0] = True
        before[1:] = space[:-1]
        after = np.empty(n, dtype=bool)
        after[-1] = True
        after[:-1] = space[1:]
        inner = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        before[inner] = True
        after[inner - 1] = True
        starts = np.flatnonzero(~space & before)
        ends = np.flatnonzero(~space & after) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def prefix(self) -> np.ndarray:
        """Prefix sums of a polynomial hash; see ``span_hash``."""
        n = len(self.data)
        out = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * _powers(_MULT, n), out=out[1:])
        return out

    def span_hash(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans: equal spans have equal hashes wherever
        they stand."""
        back = _powers(_MULT_INV, len(self.data) + 1)
        return mix((prefix[ends] - prefix[starts]) * back[starts])


def rolling(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words, also across rows."""
    n = len(words)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    mult = _MULT + np.uint64(2 * seed)
    acc = np.zeros(n - size + 1, dtype=np.uint64)
    for k in range(size):
        acc *= mult
        acc += words[k:n - size + 1 + k]
    return mix(acc)


def inside(first: np.ndarray, size: int) -> np.ndarray:
    """Flags of the runs of ``size`` words that lie in one row. ``first`` holds
    each row's first word, with an end entry."""
    n = int(first[-1])
    if n < size:
        return np.zeros(0, dtype=bool)
    cut = np.zeros(n + 1, dtype=np.int32)  # runs that would cross a row's end
    ends = first[1:-1]
    np.add.at(cut, np.maximum(ends - size + 1, 0), 1)
    np.add.at(cut, ends, -1)
    return np.cumsum(cut)[:n - size + 1] <= 0


def sequence_hash(words: np.ndarray, first: np.ndarray, size: int, seed: int = 0):
    """(start word, 64-bit hash) of all runs of ``size`` consecutive words inside one row."""
    at = np.flatnonzero(inside(first, size))
    return at, rolling(words, size, seed)[at]


def column_bytes(column: pa.Array) -> Texts:
    """The bytes and offsets of an Arrow string or binary column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n, skip = len(column), column.offset
    if n == 0:
        return Texts(np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64))
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[skip:skip + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and len(data) else np.zeros(0, dtype=np.uint8)
    return Texts(raw[offsets[0]:offsets[-1]], offsets - offsets[0])


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, end row, texts) for runs of whole rows of at most ``most``
    bytes; a longer text is a chunk of its own."""
    whole = column_bytes(column)
    at = 0
    while at < whole.rows:
        to = int(np.searchsorted(whole.offsets, whole.offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), whole.rows)
        lo, hi = whole.offsets[at], whole.offsets[to]
        yield at, to, Texts(whole.data[lo:hi], whole.offsets[at:to + 1] - lo)
        at = to


def per_row(mask_or_values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of word values (or counts of set flags) by row."""
    total = np.zeros(len(mask_or_values) + 1, dtype=np.float64 if mask_or_values.dtype.kind == "f" else np.int64)
    np.cumsum(mask_or_values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Flags of the ``n`` words that lie in a run of ``size`` words from one of ``starts``."""
    delta = np.zeros(n + 1, dtype=np.int32)
    np.add.at(delta, starts, 1)
    np.add.at(delta, starts + size, -1)
    return np.cumsum(delta[:n]) > 0
