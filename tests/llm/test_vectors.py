"""Hard negatives and vector codes against brute force, with their defined
results for odd rows."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import ballkmeans, kronecker
from ledgerline.llm import vectors as V

SCHEMA = "vec_id long, embedding array<double>, label int, _row string, _id string, _whole string, _label string, score string"


def vector_frame(spark, rows):
    """Rows with extra columns whose names clash with private ones."""
    return spark.createDataFrame([(i, v, lab, "a", "b", "c", "d", "e") for i, v, lab in rows], SCHEMA)


def odd_rows(seed=0, n=230, dims=16):
    """Clustered vectors, ties, repeated ids and rows, nulls, short and non-finite vectors."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    rows = [(int(i), (centres[i % 5] + 0.3 * rng.normal(size=dims)).round(2).tolist(), int(i % 5)) for i in range(n)]
    rows += rows[:7]                                                   # whole rows again
    rows += [(100, rows[3][1], 1), (100, rows[3][1], 1), (200, rows[100][1], 2), (0, rows[9][1], 4)]  # one id, other rows
    rows += [(1000 + i, rows[i][1], (rows[i][2] + 1) % 5) for i in range(40)]  # equal scores
    rows += [(300, None, 1), (400, [1.0, None], 1), (500, [math.nan] * dims, 1), (600, [math.inf] * dims, 2),
             (700, rows[0][1][:5], 3), (800, [], 0), (900, rows[1][1], None), (None, rows[2][1], 2), (None, rows[2][1], 2)]
    return rows


def whole(vector, dims):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * x) for x in vector] + [0] * (dims - len(vector))


# ------------------------------------------------------------ packed products

@pytest.mark.parametrize("size,kind", [(300, np.float64), (40_000, np.int64), (3_000_000_000, object)])
def test_packed_products_are_exact(size, kind):
    rng = np.random.default_rng(size % 97)
    x, a = rng.integers(-size, size, (37, 24)), rng.integers(-size, size, (11, 24))
    low, high = int(min(x.min(), a.min())), int(max(x.max(), a.max()))
    if kind is np.int64:  # wider than a double holds, narrower than a word
        low, high = low - 300_000_000, high
    packed = kronecker.Packed(x, low, high)
    assert packed.kind is kind
    want = x.astype(object) @ a.astype(object).T
    if kind is object:
        small = a // 1000  # scores must fit a long
        assert (packed.scores(small) == (small.astype(object) @ x.astype(object).T)).all()
    else:
        assert (packed.scores(a) == want.T).all()
    if kind is np.float64:
        assert packed.fields == 2


def test_packed_products_without_spread_or_candidates():
    ones = np.ones((4, 3), dtype=np.int64)
    assert (kronecker.Packed(ones, 0, 1).scores(ones) == 3).all()
    assert kronecker.Packed(np.zeros((0, 3), dtype=np.int64), -5, 5).scores(ones).shape == (4, 0)


# ------------------------------------------------------------ hard negatives

def slow_negatives(rows, dims, is_anchor, most=5):
    usable = [(k, i, lab, whole(v, dims)) for k, (i, v, lab) in enumerate(rows)]
    usable = [u for u in usable if u[1] is not None and u[2] is not None and u[3] is not None]
    out = []
    for k, i, lab, a in usable:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, c)), j, other) for m, j, other, c in usable if m != k)
        for s, j, _ in [t for t in scored if t[2] == lab][:most]:
            band = [(t, n) for t, n, other in scored if other != lab and 80 * -s <= 100 * -t <= 100 * -s][:most]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n) in enumerate(band)]
    return sorted(out)


def test_hard_negatives(spark, monkeypatch):
    rows = odd_rows()
    want = slow_negatives(rows, 16, lambda i: i % 20 == 0)
    got = kronecker.mine(vector_frame(spark, rows).repartition(3), lambda i: i % 20 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100
    assert {t[0] for t in want} >= {0, 100, 200, 700}
    monkeypatch.setattr(kronecker, "BLOCK", 16)            # many blocks on both sides
    monkeypatch.setattr(kronecker, "ANCHOR_BLOCK", 4)
    monkeypatch.setattr(kronecker, "CELLS", 40)
    got = kronecker.mine(vector_frame(spark, rows).repartition(5), lambda i: i % 20 == 0)
    assert sorted(map(tuple, got.collect())) == want


def test_hard_negatives_without_rows(spark):
    nothing = vector_frame(spark, [])
    assert kronecker.mine(nothing, lambda i: i % 2 == 0).count() == 0
    one = vector_frame(spark, [(100, [1.0, 2.0], 1)])
    assert kronecker.mine(one, lambda i: i % 100 == 0).count() == 0
    assert kronecker.mine(one, lambda i: i % 7 == 3).count() == 0
    two = vector_frame(spark, [(100, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2), (3, [0.7], 2), (4, [1.1], 2)])
    assert [tuple(r) for r in kronecker.mine(two, lambda i: i % 100 == 0).collect()] == [(100, 1, 1, 2, 65536, 230 * 256)]


# ------------------------------------------------------------ ball k-means

def test_rings_find_what_all_entries_find():
    for seed in range(12):
        rng = np.random.default_rng(seed)
        spread = [3, 40, 400][seed % 3]                    # few values: many ties
        x = rng.integers(-spread, spread, (700, 4))
        book = x[rng.choice(700, 64, replace=False)].copy()
        book[5] = book[9]                                  # equal entries: the lower index
        code, best = ballkmeans.nearest(x, book)
        want = np.square(x[:, None] - book[None]).sum(axis=2)
        assert (code == want.argmin(axis=1)).all() and (best == want.min(axis=1)).all()
        later = book + rng.integers(-3, 4, book.shape)
        count = {}
        for start in (code, rng.integers(0, 64, 700)):     # also from a bad start
            got, distance = ballkmeans.ball_nearest(x, later, start, count)
            want = np.square(x[:, None] - later[None]).sum(axis=2)
            assert (got == want.argmin(axis=1)).all() and (distance == want.min(axis=1)).all()
    tight = np.repeat(np.arange(64)[:, None] * 1000, 4, axis=1)
    x = tight[rng.integers(0, 64, 500)] + rng.integers(-5, 6, (500, 4))
    count = {}
    ballkmeans.ball_nearest(x, tight, ballkmeans.nearest(x, tight)[0], count)
    assert count["stable"] == 500 and count["distances"] == 500


def slow_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = max((len(v) for _, v, _ in kept), default=0)
    dims = max(1, -(-dims // parts)) * parts
    kept = [(i, whole(v, dims), lab) for i, v, lab in kept]
    width = dims // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * width:(p + 1) * width] for _, v, _ in first] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), e) for e, c in enumerate(book))

    for r in range(rounds + 1):
        codes = [[near(v[p * width:(p + 1) * width], books[p]) for p in range(parts)] for _, v, _ in kept]
        for p in range(parts if r < rounds else 0):
            for e in range(len(books[p])):
                mine = [v[p * width:(p + 1) * width] for (_, v, _), c in zip(kept, codes) if c[p][1] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, "".join(f"{e:02x}" for _, e in c), sum(d for d, _ in c), lab) for (i, _, lab), c in zip(kept, codes)]
    return out, books


def codes_of(spark, rows, **options):
    got, books = ballkmeans.compress(vector_frame(spark, rows).repartition(3), **options)
    return sorted(((r["_id"], r["_codes"].hex(), r["_error"], r["_label"]) for r in got.collect()), key=str), books


def test_codes(spark):
    rows = odd_rows(1)
    want, want_books = slow_codes(rows)
    got, books = codes_of(spark, rows)
    assert got == sorted(want, key=str) and books.tolist() == want_books
    text = ",".join(str(x) for book in want_books for c in book for x in c)
    assert ballkmeans.digest(books) == hashlib.sha256(text.encode()).hexdigest()
    code = next(r for r in got if r[0] == 5)
    restored = ballkmeans.decoded(bytes.fromhex(code[1]), books)
    assert np.square(restored - np.array(whole(rows[5][1], 16))).sum() == code[2]


def test_codes_of_few_rows_and_other_shapes(spark):
    rows = odd_rows(2)
    for part in (rows[:1], rows[:20], rows[-9:]):
        want, want_books = slow_codes(part)
        got, books = codes_of(spark, part)
        assert got == sorted(want, key=str) and books.tolist() == want_books
    want, _ = slow_codes(rows, parts=5, entries=8, rounds=3)  # 16 dimensions in 5 parts: filled up
    assert codes_of(spark, rows, parts=5, entries=8, rounds=3)[0] == sorted(want, key=str)
    for none in ([], [(1, None, 2)]):
        got, books = codes_of(spark, none)
        assert got == [] and books.size == 0


def test_rounds_only_lower_the_error(spark):
    rows = odd_rows(3)
    total = [sum(r[2] for r in codes_of(spark, rows, entries=8, rounds=k)[0]) for k in (0, 1, 4)]
    assert total[0] > total[1] >= total[2]


def test_whole_numbers(spark):
    rows = [(i, v, lab) for i, v, lab in odd_rows()]
    got = vector_frame(spark, rows).select(V.whole(F.col("embedding"), 256.0).alias("w")).collect()
    assert [r.w for r in got] == [None if whole(v, 0) is None else whole(v, len(v)) for _, v, _ in rows]
