"""MinHash groups against all pairs of word-run sets, with their defined
results for odd rows."""

import random

import numpy as np
import pytest

from ledgerline.llm import minhash

from .conftest import frame, lower, prose, words


def slow_set(text, size=5):
    w = words(lower(text))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def slow_groups(rows, percent=85, size=5):
    """Sorted (id, set size, smallest id of the group)."""
    sets = [slow_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted(((i, len(s), i if not s else least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def groups(docs, **options):
    return sorted((tuple(r) for r in minhash.near_duplicates(docs, **options).collect()), key=str)


def edited(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**9)}"
    return " ".join(w)


def family(seed, copies, edits, n_words=260):
    """A text and variants at growing distances, some of them linked only through others."""
    rng = random.Random(seed)
    base = prose(rng, n_words)
    out, chain = [base], base
    for k in range(copies):
        out.append(edited(rng, base, k % edits))
        if k % 7 == 0:
            chain = edited(rng, chain, 1)
            out.append(chain)
    return out


def test_groups(spark, messy):
    rows, docs = messy
    assert groups(docs) == slow_groups(rows)


def test_families_in_many_blocks(spark):
    texts = [t for s in range(4) for t in family(s, 60, 7)]
    random.Random(1).shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    want = slow_groups(rows)
    assert 4 < len({r[2] for r in want}) < len(rows) / 2
    docs = frame(spark, rows).repartition(5)
    assert groups(docs, block=5) == want          # a hot bucket in many blocks
    assert groups(docs, size=3, percent=95) == slow_groups(rows, size=3, percent=95)


def test_a_group_around_the_limit(spark):
    rng = random.Random(8)
    base = prose(rng, 150)
    # near the limit on either side: most pairs survive the posterior and fail
    rows = [(i, edited(rng, base, 1 + i % 3)) for i in range(90)]
    assert groups(frame(spark, rows), block=16) == slow_groups(rows)


def test_odd_rows(spark, odd_ids, nothing):
    rows, docs = odd_ids
    rows = [*rows, (9, "Four words of it"), (8, "four WORDS  of it"), (7, "four words of"), (6, "of"), (5, "OF ")]
    docs = frame(spark, rows)
    assert groups(docs) == slow_groups(rows)
    got = minhash.near_duplicates(docs)
    assert got.columns == ["_id", "_n", "_component"]
    assert groups(nothing) == []
    rows = [(1, None), (2, ""), (3, " \n"), (None, None), (None, "a b c d e f"), (None, "a b c d e F")]
    assert groups(frame(spark, rows)) == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 0, None), (None, 2, None), (None, 2, None)]


def test_a_very_long_text(spark):
    rng = random.Random(2)
    long = prose(rng, 60_000, 4000)
    rows = [(1, long), (2, edited(rng, long, 200)), (3, edited(rng, long, 4000)), (4, prose(rng, 50))]
    assert groups(frame(spark, rows)) == slow_groups(rows)


# ------------------------------------------------------------ the posterior

def lost_share(similarity, percent=85, miss=minhash.MISS):
    """Exact probability that sequential comparison drops a pair."""
    p = similarity + (1 - similarity) / 256
    chance, lost = np.zeros(minhash.PLACES + 1), 0.0
    chance[0] = 1
    for bound in minhash.least_matches(percent, miss):
        for _ in range(minhash.BATCH):
            chance = np.concatenate([[0], chance[:-1] * p]) + chance * (1 - p)
        lost += chance[:bound].sum()
        chance[:bound] = 0
    return lost


def test_posterior_bounds():
    bounds = minhash.least_matches(85, minhash.MISS)
    assert len(bounds) == minhash.PLACES // minhash.BATCH and list(bounds) == sorted(bounds)
    assert lost_share(0.85) < 1e-6 and lost_share(0.9) < 1e-8     # links stay
    assert lost_share(0.5) > 0.9999 and lost_share(0.3) > 0.9999  # others go
    assert (1 - 0.85 ** minhash.ROWS) ** minhash.BANDS < 1e-6     # and are candidates at all
    loose = minhash.least_matches(85, 1e-2)
    assert all(a >= b for a, b in zip(loose, bounds))


@pytest.mark.parametrize("share", [0.5, 0.85, 0.95])
def test_signatures_estimate_the_similarity(share):
    rng = np.random.default_rng(4)
    common = rng.integers(0, 1 << 63, int(2000 * share), dtype=np.uint64)
    own = rng.integers(0, 1 << 63, 2000 - len(common), dtype=np.uint64)
    half = len(own) // 2
    one, two = np.concatenate([common, own[:half]]), np.concatenate([common, own[half:]])
    rows = np.repeat([0, 1], [len(one), len(two)])
    _, sizes, places, bands = minhash.signatures_of(rows, np.concatenate([one, two]))
    assert sizes.tolist() == [len(one), len(two)] and bands.shape == (2, minhash.BANDS)
    assert abs((places[0] == places[1]).mean() - share) < 0.12


def test_survivors_are_those_that_no_batch_drops():
    rng = np.random.default_rng(6)
    left = rng.integers(0, 256, (60, minhash.PLACES), dtype=np.uint8)
    right = np.where(rng.random(left.shape) < np.linspace(0, 1, 60)[:, None], left, rng.integers(0, 256, left.shape, dtype=np.uint8))
    every = np.arange(60)
    kept, equal = minhash.survivors(every, every, left, right, 85, minhash.MISS)
    bounds = minhash.least_matches(85, minhash.MISS)
    same = np.cumsum(left == right, axis=1)[:, minhash.BATCH - 1::minhash.BATCH]
    assert kept.tolist() == np.flatnonzero((same >= bounds).all(axis=1)).tolist()
    assert equal.tolist() == same[kept, -1].tolist()
