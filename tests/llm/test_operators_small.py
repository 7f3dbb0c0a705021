"""Each operator against a brute-force form on small documents, with its
defined results for nulls, empty and long texts, ties, repeated rows, empty
tables and clashing columns."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import bpe, line_frequency, maxent, nb_svm, packing, repeats, simhash, topk

from .conftest import frame, lower, prose, words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------ 1 quality rules

def base_counts(text):
    w = words(text)
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    places = collections.defaultdict(list)
    for i in range(len(w) - 7):
        places[tuple(w[i:i + 8])].append(i)
    repeat = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), again, len(repeat)


def test_line_counts(messy):
    rows, docs = messy
    got = {r["_id"]: r for r in line_frequency.line_frequency(docs).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(t), i
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_frequent_lines_are_cut(spark):
    rng = random.Random(3)
    rows = [(i, f"Shared  LINE {i % 10} of all pages\n{prose(rng, 40)}") for i in range(30)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]                 # exact copies are documents too
    rows += [(200 + i, "shared line 5 of all pages\n" + f"w{i}") for i in range(3)]  # almost nothing else: depleted
    docs = frame(spark, rows).withColumn("source", F.lit("h"))
    got = {r["_id"]: r for r in line_frequency.line_frequency(docs, max_docs_per_host=62).collect()}
    assert all(r.n_removed_words == 6 for r in got.values())           # blanks, case and digits are folded
    assert all(got[i].kept for i in range(30)) and all(got[200 + i].depleted for i in range(3))
    assert all(r.n_removed_words == 0 for r in line_frequency.line_frequency(docs, max_docs_per_host=63).collect())
    clean = {r.doc_id: r.text for r in line_frequency.clean_documents(docs, max_docs_per_host=62).collect()}
    assert set(clean) == set(range(30)) | set(range(100, 130))
    assert all("pages" not in t for t in clean.values()) and clean[7] == rows[7][1].split("\n", 1)[1]


def test_lines_of_many_copies_are_cut(spark):
    """Thousands of documents that are one text: its lines are frequent, the documents depleted."""
    rng = random.Random(41)
    page, rest = prose(rng, 60), [prose(rng, 60) for _ in range(20)]
    rows = [(i, page) for i in range(2000)] + [(None, page), (None, page)] + [(3000 + i, t) for i, t in enumerate(rest)]
    docs = frame(spark, rows).withColumn("source", F.lit("h"))
    got = line_frequency.line_frequency(docs).collect()
    assert len(got) == len(rows)
    assert all(r.depleted and r.n_removed_words == r.n_words for r in got if r["_id"] is None or r["_id"] < 3000)
    assert all(r.kept for r in got if r["_id"] is not None and r["_id"] >= 3000)


def test_a_hot_line_can_be_split(spark):
    """The join with the frequent lines reads a written table on both sides of
    the grouping, so AQE may split a line that a third of all documents hold."""
    rng = random.Random(42)
    rows = [(i, "a line of every page of this host\n" + " ".join(words(prose(rng, 25)))) for i in range(1500)]
    docs = frame(spark, rows).withColumn("source", F.lit("h"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = line_frequency.line_frequency(docs.repartition(8))
        assert all(r.n_removed_words == 8 for r in found.collect())
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan


# ------------------------------------------------------------ 2 classifier

def test_dual_descent_solves_the_hinge_problem():
    rng = np.random.default_rng(0)
    docs = [np.sort(rng.choice(40, 8, replace=False)) for _ in range(60)]
    y = np.array([1 if (d < 20).sum() >= 4 else -1 for d in docs])
    values = [np.full(8, 1 / math.sqrt(8)) for _ in docs]
    w, b = nb_svm.dual_descent(docs, values, y, epochs=400, tolerance=1e-9)

    def loss(w, b):
        return (w @ w + b * b) / 2 + sum(max(0, 1 - t * (w[d] @ v + b)) for d, v, t in zip(docs, values, y))

    best = loss(w, b)
    for _ in range(50):
        d = rng.normal(size=w.size) * 0.01
        d[40:] = 0
        assert loss(w + d, b + rng.normal() * 0.01) >= best - 1e-6


def test_classifier_learns_and_scores_everything(spark, messy, nothing):
    rng = random.Random(7)
    good = [(i, prose(rng, 60)) for i in range(200)]
    bad = [(1000 + i, " ".join(w + "###" for w in words(prose(rng, 60)))) for i in range(100)]
    docs = frame(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad] + [(None, 1), (5, None), (6, 7)],
                                   "doc_id long, quality int")
    model = nb_svm.learn(docs, labels)
    assert np.array_equal(nb_svm.learn(docs, labels).weight, model.weight)
    got = {r.doc_id: r["_quality_score"] for r in nb_svm.score(docs, model).collect()}
    assert all(got[i] > 0.7 for i, _ in good) and all(got[i] < 0.3 for i, _ in bad)
    rows, messy_docs = messy
    scored = nb_svm.score(messy_docs, model)
    assert scored.columns == [*messy_docs.columns, "_quality_score"] and scored.count() == len(rows)
    assert scored.filter("_quality_score between 0 and 1").count() == len(rows)
    assert nb_svm.score(nothing, model).count() == 0
    one_class = nb_svm.learn(docs, labels.filter("quality = 1"))
    assert nb_svm.score(docs, one_class).agg(F.min("_quality_score")).first()[0] > 0.9
    empty = nb_svm.learn(docs, labels.limit(0))
    assert nb_svm.score(docs, empty).agg(F.max("_quality_score")).first()[0] == pytest.approx(0.5)


# ------------------------------------------------------------ 3 SimHash

def slow_fingerprint(text):
    w = words(lower(text))
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def slow_components(prints):
    """Smallest label of each linked group; prints: {label: fingerprint}."""
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if (prints[i] ^ prints[j]).bit_count() <= 2 and label[i] < label[j]:
                    label[j] = label[i]
                    changed = True
    return label


def test_simhash_against_brute_force(messy):
    rows, docs = messy
    got = {r["_id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = {i: slow_fingerprint(t) for i, t in rows}
    assert {i: r["_fp"] % 2**64 for i, r in got.items()} == prints
    assert {i: r["_component"] for i, r in got.items()} == slow_components(prints)


def test_links_keep_every_component(spark):
    rng = random.Random(2)
    prints = {}
    for g in range(30):
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 90])):  # chains, and lists longer than the pairwise size
            prints[len(prints)] = at
            for b in rng.sample(range(64 if g % 2 else 12), rng.choice([1, 2, 3])):
                at ^= 1 << b
    distinct = sorted(set(prints.values()))
    df = spark.createDataFrame([(p - 2**64 if p >> 63 else p,) for p in distinct], "_fp long")
    edges = [(a % 2**64, b % 2**64) for a, b in simhash.links(df).collect()]
    assert all(0 < (a ^ b).bit_count() for a, b in edges)
    parent = {p: p for p in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {p: root(p) for p in distinct} == slow_components({p: p for p in distinct})


def test_simhash_odd_ids(odd_ids, nothing, spark):
    rows, docs = odd_ids
    got = sorted((str(r["_id"]), r["_component"]) for r in simhash.near_duplicates(docs).collect())
    assert got == sorted([("1", 1), ("1", 1), ("None", 1), ("None", 1), ("2", 2), ("None", 2), ("3", 3), ("3", 3), ("None", 3)])
    kept = simhash.keep_one(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(1, rows[0][1]), (2, rows[4][1]), (3, "")]
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(spark, nothing, "").count() == 0


def test_simhash_keeps_every_unique_text(spark):
    """Rows that share an id, or have none, are decided by their texts."""
    rng = random.Random(31)
    t, u, v, w = (prose(rng, 80) for _ in range(4))
    rows = [(1, t), (2, t), (2, u), (None, t), (None, v), (None, v), (7, w), (7, w), (7, w), (8, w)]
    kept = simhash.keep_one(spark, frame(spark, rows), "").collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, t), (2, u), (None, v), (7, w)], key=str)


def test_simhash_spreads_one_id(spark):
    """A third of all rows on one id, each a text of its own: all stay, and no task has them all."""
    rng = random.Random(32)
    rows = [(5 if i % 3 == 0 else 100 + i, prose(rng, 30)) for i in range(300)]
    kept = simhash.keep_one(spark, frame(spark, rows).repartition(6), "")
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(rows)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


# ------------------------------------------------------------ 4 language model

def test_language_model(spark, messy, nothing):
    rows, docs = messy
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = {r["_id"]: r for r in maxent.score_texts(docs, held).collect()}
    counts, tokens = collections.Counter(), {}
    for i, t in rows:
        tokens[i] = [*words(lower(t)), None]
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(tokens[i])
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens[i])
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens[i]), sum(counts[w] > 0 for w in tokens[i]), n)
        assert r.base_score == pytest.approx(base, abs=1e-6) and -math.inf < r.score < 0
    assert maxent.score_texts(nothing, held).count() == 0


def test_every_frequent_word_has_its_number():
    rng = np.random.default_rng(5)
    hashes = rng.integers(1, 1 << 63, maxent.HOT - 1, dtype=np.uint64) * np.uint64(2)
    hashes[1:40] = hashes[0] + np.arange(1, 40, dtype=np.uint64)  # all in one slot of the first table
    vocab = maxent.Vocabulary.of(hashes)
    assert len(vocab.hashes) == maxent.HOT and len(vocab.tables) > 1
    assert (vocab.ids(hashes) == np.arange(1, maxent.HOT)).all()
    assert (vocab.ids(hashes + np.uint64(1 << 40)) >= maxent.HOT).all()
    assert len(vocab.ids(hashes[:0])) == 0


def test_words_before_have_features_beyond_the_alphabet():
    f, number = maxent.Features(), np.arange(maxent.START + 1)
    group = np.zeros(len(number), dtype=np.int64)
    (near, far, both), places = f.of(number, number, group)
    assert near.max() < far.min() and far.max() < both.min() and both.max() < maxent.CLASS_ROWS
    assert all(0 <= x.min() and x.max() < maxent.PLACE_ROWS for x in places)
    own = [*range(maxent.TOP), maxent.START]
    for rows in (near, far):
        assert len(set(rows[own])) == len(own) and not set(rows[own]) & set(np.delete(rows, own))
    assert len(set(near)) > 5 * maxent.SYMBOLS
    symbols = maxent.Vocabulary.of(np.arange(2, maxent.HOT + 1, dtype=np.uint64)).symbols()
    bands = symbols[maxent.TOP:maxent.HOT] - maxent.TOP
    assert (np.diff(bands) >= 0).all() and set(bands) == set(range(maxent.BANDS))
    assert set(maxent.bucket(np.arange(99, dtype=np.uint64))) == set(range(maxent.BANDS, maxent.BUCKETS))


def test_all_words_share_one_probability(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{min(int(rng.paretovariate(0.4)), 60_000)}" for _ in range(400))) for i in range(120)]
    seen = sorted({w for i, t in rows for w in t.split()})
    rows = [(2 * i, t) for i, t in rows]
    probes = [(2 * i + 1, w) for i, w in enumerate([*seen, "never-seen"])]
    held = F.col("doc_id") % 2 == 1
    docs = spark.createDataFrame(rows + probes, "doc_id long, text string")
    got = {r["_id"]: r.score for r in maxent.score_texts(docs, held).filter("_held").collect()}
    # a text of one word: its probability times that of the end after it, which is at most one
    assert 0 < sum(10 ** s for s in got.values()) <= 1.0001


def test_symbol_probabilities_add_up_and_training_helps():
    rng = np.random.default_rng(3)
    text = np.tile([3, 700, 41, 900, 3, 5], 4000)
    ids = text.astype(np.uint16)
    first = np.arange(0, len(ids) + 1, 600)
    symbols = np.arange(maxent.HOT + maxent.BUCKETS) % maxent.SYMBOLS
    model = maxent.Model.unigram(np.bincount(text, minlength=maxent.SYMBOLS).astype(float))
    f = maxent.Features()
    before = maxent.log10_probability(model, f, *maxent.histories(ids, first, symbols)).mean()
    trainer = maxent.Trainer(model)
    one, two, symbol = maxent.histories(ids, first, symbols)
    for lo in range(0, len(ids), 500):
        trainer.update(one[lo:lo + 500], two[lo:lo + 500], symbol[lo:lo + 500])
    after = maxent.log10_probability(trainer.m, f, one, two, symbol).mean()
    assert after > before / 4
    for _ in range(3):
        a, b = (np.full(maxent.SYMBOLS, rng.integers(maxent.SYMBOLS)) for _ in range(2))
        total = (10 ** maxent.log10_probability(trainer.m, f, a, b, np.arange(maxent.SYMBOLS))).sum()
        assert total == pytest.approx(1, abs=1e-3)


# ------------------------------------------------------------ 5 byte pairs

def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_bpe_equals_the_library(messy, nothing):
    rows, docs = messy
    ref = tokenizer()
    got = {r["_id"]: r for r in bpe.digests(docs).collect()}
    for i, t in rows:
        ids = ref.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids), (i, t)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), (i, t)
        assert got[i].decoded_sha256 == sha(ref.decode(ids, skip_special_tokens=False))
    back = {r["_id"]: r["_text"] for r in bpe.decode_documents(bpe.encode_documents(docs)).collect()}
    assert back == {i: t or "" for i, t in rows}
    assert bpe.digests(nothing).count() == 0


def test_bpe_on_random_strings():
    ref, own = tokenizer(), bpe.codec(bpe.vocabulary_file())
    rng = random.Random(11)
    alphabet = list("abtsdmrelv'' \n\t  012!?.<|>") + ["é", "ß", " ", "　", "😀", "中", "½", "²", "́", "<|endoftext|>", "\u0085", "\x1c"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["=" * 3000, "aaaa" * 900, "\n" * 501, "".join(rng.choice("abcdef0123456789") for _ in range(4000))]
    import pyarrow as pa

    from ledgerline.llm import text as T
    at = 0
    for _, _, x in T.chunks(pa.array(texts)):
        ids, first = own.encode(x)
        for i in range(x.rows):
            assert ids[first[i]:first[i + 1]].tolist() == ref.encode(texts[at], add_special_tokens=False).ids, repr(texts[at])
            at += 1


def test_bpe_cache_shrinks_without_changing_results(monkeypatch):
    import pyarrow as pa

    from ledgerline.llm import text as T
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 50)
    own, ref, rng = bpe.Codec(bpe.vocabulary_file()), tokenizer(), random.Random(4)
    for _ in range(30):
        text = prose(rng, 30)
        ids, _ = own.encode(T.column_bytes(pa.array([text])))
        assert ids.tolist() == ref.encode(text, add_special_tokens=False).ids


# ------------------------------------------------------------ 8 packing

def test_packing(messy, nothing):
    rows, docs = messy
    ref = tokenizer()
    got = packing.pack(docs, keep_ids=True).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r["_id"]].append(r)
        by_sequence[r["_sequence"]].append(r)
    assert set(by_doc) == {i for i, _ in rows}
    for i, t in rows:
        ids = ref.encode(t or "", add_special_tokens=False).ids + [0]
        at = 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r["_piece"])):
            assert (r["_piece"], r["_start"]) == (k, at) and (r["_length"] == 2048 or k == 0)
            raw = np.array(ids[at:at + r["_length"]], dtype="<u4").tobytes()
            assert bytes(r["_ids"]) == raw and r["_crc"] == zlib.crc32(raw)
            at += r["_length"]
        assert at == len(ids)
    for some in by_sequence.values():
        at = 0
        for r in sorted(some, key=lambda r: r["_offset"]):
            assert r["_offset"] == at
            at += r["_length"]
        assert at <= 2048
    assert len(by_sequence) <= sum(r["_length"] for r in got) / 2048 + 2
    assert packing.pack(nothing).count() == 0


def test_repeated_rows_spread_over_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 50)
    docs = frame(spark, [(None, "one text")] * 400)
    got = packing.pack(docs, most_documents=3).collect()
    groups = collections.Counter(r["_sequence"] >> 32 for r in got)
    assert len(got) == 400 and len(groups) > 4 and max(groups.values()) <= 100
    assert max(collections.Counter(r["_sequence"] for r in got).values()) == 3


@pytest.mark.parametrize("most,attention", [(3, 2048**2), (2048, 900**2), (2, 1000**2)])
def test_best_fit_keeps_every_capacity(most, attention):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 900, 700)
    sequence, place = packing.best_fit(lengths, 2048, most, attention)
    for s in np.unique(sequence):
        mine = np.flatnonzero(sequence == s)
        order = mine[np.argsort(place[mine])]
        assert len(mine) <= most and (lengths[mine] ** 2).sum() <= attention and lengths[mine].sum() <= 2048
        assert place[order].tolist() == [0, *np.cumsum(lengths[order])[:-1]]


# ------------------------------------------------------------ 9 exact search

def slow_top(rows, k, is_query):
    use = [(i, np.floor(256 * np.array(v, dtype=np.float64))) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(len(v) for _, v in use)
    use = [(i, np.pad(v, (0, width - len(v)))) for i, v in use]
    return sorted((q, r + 1, i, s) for m, (q, v) in enumerate(use) if is_query(q)
                  for r, (s, i) in enumerate(sorted(((-int(v @ x), i) for n, (i, x) in enumerate(use) if n != m))[:k]))


def test_top_k(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=24) / 5).round(2).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 60, 3)]  # ties
    rows += [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 24), (2150, [float("inf")] * 24), (None, rows[0][1]),
             (2200, []), (2250, [0.5, -0.5]), (50, rows[1][1]), (50, rows[50][1]), (100, rows[100][1])]  # ids on several rows
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    typed = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = slow_top(typed, 5, lambda q: q % 50 == 0)
    found = topk.top_k(df.repartition(3), lambda c: c % 50 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((r.query_id, r["rank"], r.vec_id, -r.score) for r in found.collect()) == want
    twin = spark.createDataFrame([(50, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [0.25, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(twin, lambda c: c % 50 == 0).collect())) == [
        (50, 1, 50, 32768), (50, 1, 50, 32768), (50, 2, 1, 8192), (50, 2, 1, 16384)]
    assert topk.top_k(df.limit(0), lambda c: c % 50 == 0).count() == 0
    few = topk.top_k(df.filter("vec_id in (0, 1, 2)"), lambda c: c % 50 == 0).collect()
    assert len(few) == 2


def test_bounds_drop_candidates_but_no_result():
    rng = np.random.default_rng(9)
    columns = rng.integers(-200, 200, (64, 3000)) * np.array([20] * 8 + [1] * 56)[:, None]
    ids = np.arange(3000)
    queries = columns[:, :20].T.copy()
    floors = {}
    for q, found, scores in topk.search_block(queries, ids[:20], columns, ids, ids, 5, floors):
        all_scores = queries[q] @ columns
        all_scores[q] = -10**9
        best = np.lexsort((ids, -all_scores))[:5]
        assert found.tolist() == best.tolist() and scores.tolist() == all_scores[best].tolist()


# ------------------------------------------------------------ 10 repeats

def slow_repeats(rows, size=20):
    last = 2**63 - 1
    first = {}
    table = [(last if i is None else i, words(t)) for i, t in rows]
    for i, w in table:
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            first[key] = min(first.get(key, (i, k)), (i, k))
    out = []
    for i, w in table:
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < (i, k):
                gone.update(range(k, k + size))
        out.append((i, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return sorted(out)


def test_repeats_against_brute_force(messy, odd_ids, nothing):
    for rows, docs in (messy, odd_ids):
        got = sorted((2**63 - 1 if r["_id"] is None else r["_id"], r.n_words, r.n_removed, r.kept_sha256)
                     for r in repeats.digests(docs).collect())
        assert got == slow_repeats(rows)
        cut = repeats.remove_repeats(docs)
        assert cut.columns == docs.columns and cut.count() == len(rows)
        want = collections.Counter(r[3] for r in slow_repeats(rows))
        assert collections.Counter(sha(" ".join(words(r.text))) for r in cut.collect()) == want
        assert all(r.n_chars is None or r.n_chars == len(r.text) for r in cut.collect())
    assert repeats.digests(nothing).count() == 0 and repeats.remove_repeats(nothing).count() == 0


def test_anchor_estimates_are_never_too_low(monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(2)
    spread = np.uint64(0x9E3779B97F4A7C15)
    parts = [rng.choice(5000, 900, replace=False).astype(np.uint64) * spread for _ in range(6)]
    parts[0] = np.concatenate([parts[0], np.full(5, 9999, dtype=np.uint64) * spread])  # only in one part, but often
    counts = collections.Counter(np.concatenate(parts).tolist())
    batch = pa.RecordBatch.from_arrays([pa.array(list(range(6)), type=pa.int64()),
                                        pa.array([p.tobytes() for p in parts], type=pa.binary())], names=["_part", "_anchors"])
    too_many = []
    for bits in (32, 11):  # a narrow sketch overestimates more, and still loses none
        monkeypatch.setattr(repeats, "CELL_BITS", bits)
        sent = pa.Table.from_batches(list(repeats._sketch(3)(iter([batch]))))
        lines = sent.column("_line").to_numpy()
        assert set(lines.tolist()) == set(range(3 * repeats.DEPTH))
        out = pa.concat_tables([repeats.merge_sketches(sent.filter(pa.array(lines == i))) for i in set(lines.tolist())])
        wrong = 0
        for part, anchors in enumerate(parts):
            mine = out.filter(pa.array(out.column("_part").to_numpy() == part))
            marked = repeats.Marked(mine.column("_line").to_pylist(), mine.column("_cells").to_pylist(), 3).has(anchors)
            repeated = np.array([counts[h] > 1 for h in anchors.tolist()])
            assert marked[repeated].all()
            wrong += int((marked & ~repeated).sum())
        too_many.append(wrong)
    assert too_many[0] == 0 and too_many[1] > 0
    assert not repeats.Marked([None], [None], 3)


def test_repeats_over_several_parts_of_a_task(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * 7777 + j * j) % 50021}" for j in range(60_000))) for i in range(6)]
    rows += [(7, rows[3][1]), (None, rows[0][1][200_000:])]
    monkeypatch.setattr(repeats, "PART_CHUNKS", 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert repeats.blocks_of(docs, "doc_id", "text", 20).select("_part").distinct().count() > 2
    got = sorted((2**63 - 1 if r["_id"] is None else r["_id"], r.n_words, r.n_removed, r.kept_sha256)
                 for r in repeats.digests(docs).collect())
    assert got == slow_repeats([(2**63 - 1 if i is None else i, t) for i, t in rows])


def test_equal_windows_have_equal_anchors():
    from ledgerline.llm import text as T
    rng = np.random.default_rng(8)
    w = rng.integers(0, 3, 4000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # few words: many ties
    first = np.array([0, 5, 5, 1500, 4000])
    ok, anchor, used, grams = repeats.window_anchors(w, first)
    seen, span = {}, repeats.SIZE - repeats.GRAM + 1
    for s in np.flatnonzero(ok):
        near = grams[s:s + span]
        assert anchor[s] == near.min() and used[s:s + span][near == anchor[s]].all()
        assert seen.setdefault(w[s:s + 20].tobytes(), anchor[s]) == anchor[s]
    assert len(T.inside(first, 20)) == len(ok)


def test_windows_are_equal_only_if_both_hashes_are(spark):
    rows = [(1, 0, 7, 1), (2, 0, 7, 2), (2, 5, 7, 2), (3, 0, 7, 1), (4, 0, 8, 1)]
    df = spark.createDataFrame(rows, "_id long, _start int, _window long, _window2 long")
    got = sorted((r["_id"], r["_start"]) for r in repeats._later(df, ["_window", "_window2"]).collect())
    assert got == [(2, 5), (3, 0)]
    w = np.random.default_rng(4).integers(0, 2**63, 500).astype(np.uint64)
    w = np.concatenate([w, w])
    a, b = (repeats._Spans(x).hash(np.arange(980), np.arange(980) + 20) for x in (w, repeats._second(w)))
    assert (a[:480] == a[500:]).all() and (b[:480] == b[500:]).all() and not (a == b).any()
