"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts drawn from the whole training fold, whatever their labels, are the unlabelled
ones; texts labelled harmless are not used as negatives. With the class prior q the risk is
``q * E_P[loss(+)] + max(0, E_U[loss(-)] - q * E_P[loss(-)])``: the second part estimates the negatives' risk, and where it
turns negative the step goes the other way, which keeps a flexible model from fitting the positives by heart. The prior is
the share of toxic rows among the labelled rows of the training fold.

Features are which words a text has (A-Z lower-cased, letters and whatever is not ASCII) and with which 3 to 7 letters its
words begin, hashed into ``BUCKETS``; the model is a numpy logistic one. Only features that are in ``MIN_TEXTS`` positives and
stand out in them against the unlabelled texts by ``LEAST_Z`` standard errors have a weight: the positives are few and words
are many, and what does not stand out would only be learnt by heart.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import require, text_slices
from .sampling import drawn, labelled

#: Rows that the model is fitted on, about, at most: confirmed toxic ones, and unlabelled ones.
POSITIVE_ROWS, UNLABELLED_ROWS = 8_000, 16_000
BUCKETS, MIN_TEXTS, LEAST_Z = 1 << 18, 4, 6.0
STEPS, RATE, DECAY = 300, 0.1, 1e-4
#: Lengths of the beginnings of words that are features.
STEMS = (3, 4, 5, 6, 7)
#: Prior where no labelled row tells one.
PRIOR = 0.1
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def features(text: str) -> np.ndarray:
    """The buckets of a text's features, ascending."""
    words = set(text.encode().translate(_FOLD).decode().split())
    found = set(words)
    for k in STEMS:
        found.update(["^" + w[:k] for w in words if len(w) > k])
    return np.unique(np.array([zlib.crc32(w.encode()) & (BUCKETS - 1) for w in found], np.int32))


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        v = np.array([self.weights[features(t)].sum(dtype=np.float64) for t in texts]) + self.bias
        return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def _texts_with(rows: list[np.ndarray]) -> np.ndarray:
    """In how many rows each bucket is; few rows at a time are joined, so the sample is never copied whole."""
    out = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(rows), 500):
        out += np.bincount(np.concatenate(rows[at : at + 500]), minlength=BUCKETS)
    return out


def nn_gradient(v: np.ndarray, p: np.ndarray, prior: float, n_p: int, n_u: int) -> np.ndarray:
    """The step's gradient by the logits v, of which p are positives': that of the whole risk, or where the estimate of the
    negatives' risk is below zero, that of its opposite alone."""
    s = 1 / (1 + np.exp(-np.clip(v, -30, 30)))
    loss_minus = np.logaddexp(0, v)
    negative = loss_minus[~p].sum() / n_u - prior * loss_minus[p].sum() / n_p
    minus = np.where(p, -prior * s / n_p, s / n_u)
    return np.where(p, prior * (s - 1) / n_p, 0) + minus if negative >= 0 else -minus


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> ToxicityModel:
    """Full-batch Adam on the non-negative risk with the log loss."""
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    with_p, with_u = _texts_with(positive), _texts_with(unlabelled)
    usual = np.minimum((with_u + 1) / (n_u + 2), 0.999)
    used = np.flatnonzero((with_p >= MIN_TEXTS) & ((with_p / n_p - usual) / np.sqrt(usual * (1 - usual) / n_p) >= LEAST_Z))
    column = np.full(BUCKETS, -1)
    column[used] = np.arange(len(used))
    rows = [c[c >= 0] for r in positive + unlabelled for c in [column[r]]]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    p = np.arange(len(rows)) < len(positive)
    w = np.zeros(len(used) + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        v = np.bincount(row, weights=w[flat], minlength=len(rows)) + w[-1]
        g = nn_gradient(v, p, prior, n_p, n_u)
        grad = np.append(np.bincount(flat, weights=g[row], minlength=len(used)), g.sum())
        grad[:-1] += DECAY * w[:-1]
        first += 0.1 * (grad - first)
        second += 0.001 * (grad * grad - second)
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = w[:-1]
    return ToxicityModel(weights, float(w[-1]))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, fold: Column, label_col: str = "toxic", text_col: str = "text", id_col: str = "doc_id", positive_rows: int = POSITIVE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS
) -> ToxicityModel | None:
    """Fit on the rows where ``fold`` (a condition on a column ``id``) holds; None without confirmed toxic texts."""
    known = labelled(labels, id_col, label_col).where(fold)
    total, toxic = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not toxic:
        return None
    prior = min(0.9, toxic / total) if total > toxic else PRIOR
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body")).where(fold)
    confirmed = drawn(known.where(F.col("label") == 1).select("id"), "id", positive_rows, "toxic", toxic)
    positives = texts.join(F.broadcast(confirmed), "id").select("body")  # positive_rows bounds the broadcast
    others = drawn(texts, "id", unlabelled_rows, "unlabelled").select("body")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([features(t).tobytes() for t in batch.column(0).to_pylist()], pa.binary())], names=["x"])

    got = [sorted(df.mapInArrow(hashed, "x binary").toArrow().column("x").to_pylist()) for df in (positives, others)]
    return fit_nnpu(*[[np.frombuffer(x, np.int32) for x in rows] for rows in got], prior)


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text", keep: Sequence[str] = ("doc_id",), cut: float = 0.5) -> DataFrame:
    """The ``keep`` columns, ``score`` double (probability of being toxic) and ``predicted`` int (1 from ``cut`` on) of every
    whole text. Null is ''; a text without words gets the bias alone; without a model all scores are 0. Other columns are
    ignored; repeated rows come back each."""
    require(docs, text_col, *keep)
    if clash := {k.lower() for k in keep} & {"score", "predicted"}:
        raise ValueError(f"kept columns named as results: {', '.join(sorted(clash))}")
    keep = list(keep)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*(docs.schema[k] for k in keep), T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            p = sent.value.scores(texts) if sent.value is not None else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(p), pa.array((p >= cut).astype(np.int32))], names=[*keep, "score", "predicted"])

    return docs.select(*keep, text_col).mapInArrow(run, schema)
