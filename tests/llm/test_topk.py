import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthmill.llm import topk as K


def brute(rows, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i, q in {i: v for i, v in sorted(ok, reverse=True)}.items():
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in ok if j != i)
            out |= {(i, r + 1): (j, -s) for r, (s, j) in enumerate(scores[:k])}
    return out


def ask(spark, rows, k=5, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in K.top_inner_products(df, F.col("vec_id") % 50 == 0, k, **options).collect()}


@pytest.mark.parametrize("options", [{}, {"slab_rows": 60, "block_rows": 3}])
@pytest.mark.parametrize("kind", ["unit", "skewed", "ties"])
def test_against_brute_force(spark, options, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 12)).astype(np.float32)
    if kind == "unit":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "skewed":
        x *= rng.pareto(1.0, (400, 1)).astype(np.float32)
    if kind == "ties":
        x = np.repeat(np.round(x[:8]), 50, axis=0)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    random.Random(1).shuffle(rows)
    assert ask(spark, rows, **options) == brute(rows, 5)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0]), (None, [9.0, 9.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (50, [0.0, 0.0]), (0, [1.0, 2.0])]
    assert ask(spark, rows) == brute(rows, 5)
    assert ask(spark, []) == {} and ask(spark, [(0, [1.0])]) == {}


def test_large_integers_stay_exact(spark):
    rows = [(i, [float(2**17 + i), float(2**17 - i), 1.0]) for i in range(120)]
    assert ask(spark, rows) == brute([(i, np.float32(v).tolist()) for i, v in rows], 5)


def test_pruning_drops_nothing():
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(3000, 16)) * rng.pareto(1.5, (3000, 1)) * 50)
    x = x[np.argsort(-np.linalg.norm(x, axis=1), kind="stable")]
    q = np.floor(rng.normal(size=(20, 16)) * 100)
    row, ids, score = K.match(np.arange(3000), x, np.full(20, -1), q, np.full(20, -np.inf), 5, K.rotation(x))
    full = q @ x.T
    for i in range(20):
        assert sorted(score[row == i].tolist(), reverse=True) == np.sort(full[i])[::-1][:5].tolist()
