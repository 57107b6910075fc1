import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from monthmill.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages(spark, sf, stages):
    docs, good, lines, near, clean, tokens = stages
    for df in (good, lines, near, clean):
        assert df.dtypes == docs.dtypes
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert sum(labels[i] for i in labels if i in kept) >= 0.9 * sum(labels.values())  # some sixty labelled rows to learn from
    assert lines.count() == good.count()
    from test_linededup import brute

    texts = {r.doc_id: r.text for r in good.collect()}
    want = dict(zip(texts, brute(list(texts.values()), 10), strict=True))
    assert {r.doc_id: r.text for r in lines.collect()} == want
    assert len({r.text for r in near.collect()}) == near.count()
    from test_decontam import brute as hits

    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in near.collect() if not hits(r.text, items)[1]}
    assert 0 < clean.count() < near.count() < docs.count()
    reference = Tokenizer.from_file(tokenizer_path())
    texts = {r.doc_id: r.text for r in clean.collect()}
    for r in tokens.collect():
        assert r.token_ids == reference.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_quality_stage_keeps_good_documents(spark):
    """On a table with labelled rows enough to learn from."""
    sf = "/root/testdata/sf0.1"
    kept = P.STAGES[0][1](spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).select("doc_id")
    good = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").select("doc_id")
    assert good.join(kept, "doc_id").count() >= 0.97 * good.count()


def test_run_equals_its_stages(spark, sf, stages):
    got = {r.doc_id: r.n_tokens for r in P.run(spark, sf).collect()}
    assert got == {r.doc_id: r.n_tokens for r in stages[-1].collect()}


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stage_edges(spark, sf, odd_docs, no_docs, name):
    stage = dict(P.STAGES)[name]
    assert stage(spark, no_docs, sf).count() == 0
    rows = stage(spark, odd_docs, sf)
    assert 0 < rows.count() <= odd_docs.count()
