"""Whole-number vectors, shared by the operators on embeddings.

Components become ``floor(scale * x)`` with ``x`` as a double. Vectors that are
null or hold null or non-finite components take no part; vectors shorter than
the longest one are filled up with zeros. Components must fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NARROW = ((1 << 15, np.int16), (1 << 31, np.int32))


def whole(vector: Column, scale: float) -> Column:
    """The vector's whole-number components; null where it takes no part."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("long")))


def extent(vectors: DataFrame, column: str) -> tuple[int, int, int]:
    """(longest length, smallest, largest component) of a whole-number column."""
    r = vectors.agg(F.max(F.size(column)), F.min(F.array_min(column)), F.max(F.array_max(column))).first()
    return int(r[0] or 0), min(int(r[1] or 0), 0), max(int(r[2] or 0), 0)


def narrow(low: int, high: int):
    """The narrowest numpy integer kind for components in ``low..high``."""
    return next((kind for size, kind in NARROW if -size <= low and high < size), np.int64)


def matrix(column: pa.Array, dims: int, kind=np.int64, fill: int = 0) -> np.ndarray:
    """Rows of an Arrow list column, filled up to ``dims`` values."""
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.flatten())
    lengths = np.diff(offsets)
    if len(column) and (lengths == dims).all():
        return values.reshape(len(column), dims).astype(kind)
    out = np.full((len(column), dims), fill, dtype=kind)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = values
    return out
