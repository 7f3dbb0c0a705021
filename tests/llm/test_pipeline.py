"""The registry, the SQL of the operators that have one, and the pipeline."""

import random

import numpy as np
import pytest

import corpus_pipeline
from ledgerline.llm import oracle_sql, registry, secrets, simhash
from oracle.compare import digest, duck

from .conftest import frame, prose, words
from .test_operators_small import slow_components, slow_fingerprint, slow_repeats, sha, tokenizer

SMALL = "/root/testdata/sf0.001"


def test_names():
    import __spark_entry__ as e

    names = registry.queries()
    assert [n.split("_")[0] for n in names] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(names) <= set(e.queries()) and set(registry.oracle_sql()) <= set(names)
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql_agrees(spark, name):
    df = registry.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck(SMALL).execute(registry.oracle_sql()[name])
    columns = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, rows) == digest(columns, res.fetchall())
    assert oracle_sql.WORD


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    good = [prose(rng, rng.randint(30, 120)) for _ in range(60)]
    passage = prose(rng, 45)
    texts = [*good, *good[:5], *(g + " tail" for g in good[5:10]), *(f"{prose(rng, 30)} {passage} {prose(rng, 30)}" for _ in range(6)),
             f"{prose(rng, 40)} password=q8Zr5LmP2x {prose(rng, 30)}",
             *(" ".join(w + "###" for w in words(prose(rng, 50))) for _ in range(30)), None, ""]
    rows = list(enumerate(texts))
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int("###" not in (t or ""))) for i, t in rows if t], "doc_id long, quality int").write.parquet(
        f"{folder}/labels.parquet")
    return rows, folder


def test_stages_against_brute_force(spark, corpus):
    rows, folder = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        inputs[name] = ({r.doc_id: r.text for r in docs.collect()}, out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = spark.createDataFrame(out.collect(), out.schema)
    before, out = inputs["quality_classifier"]
    kept = {r.doc_id for r in out.collect()}
    assert all("###" not in (before[i] or "") for i in kept)
    assert {i for i, t in rows if t and "###" not in t} <= kept
    before, out = inputs["simhash_dedup"]
    component = slow_components({i: slow_fingerprint(t) for i, t in before.items()})
    assert {r.doc_id for r in out.collect()} == {i for i in before if component[i] == i}
    before, out = inputs["substring_dedup"]
    want = {i: (n - gone, kept) for i, n, gone, kept in slow_repeats(list(before.items()))}
    assert {r.doc_id: (len(words(r.text)), sha(" ".join(words(r.text)))) for r in out.collect()} == want
    before, out = inputs["secret_scan"]
    after = {r.doc_id: r.text for r in out.collect()}
    assert {i for i in before if before[i] != after[i]} == {i for i, t in before.items() if "password=" in (t or "")}
    assert any(secrets.MARK in (t or "") for t in after.values())
    before, out = inputs["best_fit_packing"]
    ids = {i: len(tokenizer().encode(t or "", add_special_tokens=False).ids) + 1 for i, t in before.items()}
    packed = out.collect()
    assert sum(r.length for r in packed) == sum(ids.values())
    assert len({r.sequence_id for r in packed}) <= -(-sum(ids.values()) // 2048) + 1
    whole = sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed)
    run = registry.queries()["pipeline"](spark, folder)
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in run.collect()) == whole
    assert np.isfinite([r.offset for r in packed]).all() and simhash.MAX_BITS == 2


def test_empty_corpus(spark, corpus, tmp_path):
    _, folder = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for name, query in registry.queries().items():
        if name not in ("op9_top_k", "op12_kronecker", "op13_ball_kmeans", "pipeline"):
            assert query(spark, str(tmp_path)).count() == 0, name
