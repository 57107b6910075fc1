import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthmill.llm import quality as Q
from monthmill.llm import toxicity as X
from monthmill.llm.queries import op4_toxicity, op9_quality
from monthmill.llm.sampling import drawn, fold, labelled


def docs_and_labels(spark, column):
    rng = np.random.default_rng(1)
    common = [f"word{i}" for i in range(80)]
    rows = []
    for i in range(600):
        words = rng.choice(common, 40).tolist()
        bad = i % 4 == 0
        if bad and column == "toxic":
            words[5] = words[20] = f"nasty{rng.integers(3)}"
        if bad and column == "quality":
            words = [w + "$$$" for w in words]
        rows.append((i, " ".join(words), int(bad) if column == "toxic" else int(not bad)))
    df = spark.createDataFrame(rows, f"doc_id bigint, text string, {column} int")
    return df.select("doc_id", "text"), df.select("doc_id", column).where(F.col("doc_id") % 10 != 9)


def test_quality_separates_held_out_rows(spark):
    docs, labels = docs_and_labels(spark, "quality")
    model = Q.fit_quality(docs, labels, fold(F.col("id"), 4) != 2)
    out = {r.doc_id: r for r in Q.score_quality(docs, model).collect()}
    held = [i for i in out if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([out[i].predicted == (i % 4 != 0) for i in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in out.values())
    again = Q.fit_quality(docs, labels, fold(F.col("id"), 4) != 2)
    assert np.allclose(again.scores(["word1 word2", ""]), model.scores(["word1 word2", ""]))


def test_pooling_against_plain_loops(monkeypatch):
    """Every feature is made of vectors: sums over whole texts, whatever the slices."""
    monkeypatch.setattr(Q, "SLICE", 3)
    rng = np.random.default_rng(5)
    index, context = Q.index_matrix(), rng.normal(size=(Q.BUCKETS, Q.DIM)).astype(np.float32)
    for text in ("", "one", "one one", "a b, a b, a c. a_b", " ".join(f"w{i % 13}" for i in range(50))):
        ids = [Q.bucket(t) for t in Q._TOKEN.findall(text)]
        n = max(len(ids), 1)
        mean = [sum((v[i] for i in ids), np.zeros(Q.DIM)) / n for v in (index, context)]
        spread = np.sqrt(sum(((context[i] - mean[1]) ** 2 for i in ids), np.zeros(Q.DIM)) / n)
        bound = [sum((index[a] * index[b] for a, b in zip(ids, ids[k:], strict=False)), np.zeros(Q.DIM)) / max(len(ids) - k, 1) for k in range(1, Q.REACH + 1)]
        assert np.allclose(Q.pooled(text, index, context), np.concatenate([*mean, spread, *bound]), atol=2e-3)
        assert not Q.pooled(text, np.zeros_like(index), np.zeros_like(context)).any()


def test_context_vectors_tell_order():
    a, b, c = (Q.context_sums([t])[Q.bucket("x")] for t in ("x y", "y x", "x z"))
    assert np.count_nonzero(a) and not np.array_equal(a, b) and not np.array_equal(a, c)
    assert np.array_equal(np.roll(a, -2), b)


def test_toxicity_separates_held_out_rows(spark):
    docs, labels = docs_and_labels(spark, "toxic")
    model = X.fit_toxicity(docs, labels, fold(F.col("id"), 5) != 0)
    out = {r.doc_id: r for r in X.score_toxicity(docs, model).collect()}
    held = [i for i in out if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([out[i].predicted == (i % 4 == 0) for i in held]) > 0.97


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = docs_and_labels(spark, "toxic")
    flipped = labels.withColumn("toxic", F.when(fold(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (X.fit_toxicity(docs, x, fold(F.col("id"), 5) != 0) for x in (labels, flipped))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_negative_risk_turns_the_step():
    """More capacity than data: the unlabelled part's risk would go below zero without the correction."""
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 300, 30)).astype(np.int32) for _ in range(120)]
    for r in rows[:20]:
        r[0] = 1000
    model = X.fit_nnpu([np.sort(r) for r in rows[:10]], [np.sort(r) for r in rows], 0.2)
    assert np.isfinite(model.weights).all() and model.weights[1000] == model.weights.max() > 0


def test_temperature_calibrates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 5))
    p = 1 / (1 + np.exp(-2 * x[:, 0]))
    y = (rng.random(4000) < p).astype(int)
    net = Q.fit_network(x, y)
    assert abs(net.probabilities(x).mean() - y.mean()) < 0.03
    assert np.mean(np.abs(net.probabilities(x) - p)) < 0.1


def test_samples(spark):
    df = spark.range(10_000).withColumnRenamed("id", "doc_id")
    assert 800 < drawn(df, "doc_id", 1000, "x").count() < 1200
    assert drawn(df, "doc_id", 20_000, "x").count() == 10_000
    # 16,000 of 2e12 rows: about one of these would be drawn at 1e8 times the share, none is an error of the grain
    assert drawn(df, "doc_id", 16_000, "x", 2 * 10**12).count() <= 1 and 300 < drawn(df, "doc_id", 10**17, "x", 2 * 10**18).count() < 700
    odd = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (3, 0)], "doc_id bigint, quality int")
    assert sorted(tuple(r) for r in labelled(odd, "doc_id", "quality").collect()) == [(1, 1), (3, 0)]


@pytest.mark.parametrize("module", [Q, X])
def test_edges(spark, odd_docs, no_docs, module):
    fit, score = (Q.fit_quality, Q.score_quality) if module is Q else (X.fit_toxicity, X.score_toxicity)
    column = "quality" if module is Q else "toxic"
    none = spark.createDataFrame([], f"doc_id bigint, {column} int")
    assert fit(odd_docs, none, F.lit(True)) is None and fit(no_docs, none, F.lit(True)) is None
    one_kind = spark.createDataFrame([(1, 0), (2, 0)], f"doc_id bigint, {column} int")
    assert fit(odd_docs, one_kind, F.lit(True)) is None
    both = spark.createDataFrame([(i, i % 2) for i in range(1, 10)], f"doc_id bigint, {column} int")
    for model in (None, fit(odd_docs, both, F.lit(True))):
        out = score(odd_docs.drop("score"), model).collect()
        assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
        assert score(no_docs, model).count() == 0
    kept = Q.keep_good(odd_docs, None)
    assert kept.count() == odd_docs.count() and kept.schema == odd_docs.schema
    with pytest.raises(ValueError):
        score(odd_docs, None, keep=["score"])


def test_step_of_the_non_negative_risk():
    """Against differences of the risk, and of its correction where the negatives' part is below zero."""
    rng = np.random.default_rng(2)
    p = np.arange(60) < 20

    def parts(v):
        plus = 0.3 * np.mean(np.logaddexp(0, -v[p]))
        return plus, np.mean(np.logaddexp(0, v[~p])) - 0.3 * np.mean(np.logaddexp(0, v[p]))

    for shift, low in ((0.0, False), (-6.0, True)):
        v = rng.normal(size=60) + np.where(p, 6.0 if low else 0.0, shift)
        assert (parts(v)[1] < 0) == low
        risk = (lambda x: -parts(x)[1]) if low else (lambda x: sum(parts(x)))
        wanted = [(risk(v + e) - risk(v - e)) / 2e-5 for e in np.eye(60) * 1e-5]
        assert np.allclose(X.nn_gradient(v, p, 0.3, 20, 40), wanted, atol=1e-8)


def test_gradients_of_the_network():
    rng = np.random.default_rng(4)
    z, t = rng.normal(size=(30, 5)), (rng.random(30) < 0.5).astype(float)
    p = [rng.normal(size=s) for s in ((5, 7), (7,), (7,), (1,))]

    def loss(q):
        logit = np.maximum(z @ q[0] + q[1], 0) @ q[2] + q[3]
        return np.mean(np.logaddexp(0, logit) - t * logit) + Q.DECAY / 2 * ((q[0] ** 2).sum() + (q[2] ** 2).sum())

    for k, g in enumerate(Q.gradients(p, z, t)):
        for at in np.ndindex(g.shape):
            up, down = [a.copy() for a in p], [a.copy() for a in p]
            up[k][at] += 1e-6
            down[k][at] -= 1e-6
            assert g[at] == pytest.approx((loss(up) - loss(down)) / 2e-6, abs=1e-7)


def auc(scores, truth):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    yes = truth.astype(bool)
    return (ranks[yes].sum() - yes.sum() * (yes.sum() + 1) / 2) / (yes.sum() * (~yes).sum())


@pytest.mark.parametrize(("query", "column", "least_auc", "least_hit", "most_false"), [(op4_toxicity, "toxic", 0.93, 0.85, 0.05), (op9_quality, "quality", 0.99, 0.97, 0.05)])
def test_query_on_held_out_rows(spark, query, column, least_auc, least_hit, most_false):
    sf = "/root/testdata/sf0.1"
    out = query(spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = out.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").where(f"{column} is not null"), "doc_id").collect()
    truth, scores, said = np.array([r[column] for r in rows]), np.array([r.score for r in rows]), np.array([r.predicted for r in rows])
    assert len(rows) > 300 and auc(scores, truth) > least_auc
    assert said[truth == 1].mean() > least_hit and said[truth == 0].mean() < most_false
