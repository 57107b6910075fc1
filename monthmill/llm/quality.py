"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer numpy network.

A token's bucket is its crc32 modulo ``BUCKETS``. Each bucket has a fixed sparse index vector of +1 and -1. Its context
vector is the sum, over the sample, of the index vectors of its neighbours within ``REACH`` tokens, each permuted by where the
neighbour stands. A document is pooled into the means of its tokens' index and context vectors, the deviations of the context
vectors, and, for each step up to ``REACH``, the mean product of two tokens' index vectors that far apart: a token times itself
is never negative, so repetition shows. There are no other measures of a text. A network of one hidden layer is fitted on that, and a temperature on rows kept apart makes its outputs probabilities.

All is fitted on at most about ``sample_rows`` labelled rows; buckets and dimensions bound what is broadcast (16 MB).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialise, require, text_slices
from .sampling import drawn, labelled

#: Labelled rows that the model is fitted on, about, at most.
SAMPLE_ROWS = 20_000
BUCKETS, DIM, ONES, REACH = 1 << 16, 64, 4, 2
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-2
#: Tokens whose vectors are held at once.
SLICE = 4096
#: Tasks that gather context vectors, and ranges of buckets in which these are summed; with SAMPLE_ROWS they bound a group.
TASKS, RANGES = 12, 8
#: A probability of at least this much is called good.
CUT = 0.7
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_")


def bucket(token: str) -> int:
    return zlib.crc32(token.encode()) & (BUCKETS - 1)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For each bucket the places of its ONES entries and their signs."""
    rng = np.random.default_rng(7)
    return rng.integers(0, DIM, (BUCKETS, ONES)), rng.choice(np.array([-1.0, 1.0]), (BUCKETS, ONES))


@cache
def index_matrix() -> np.ndarray:
    place, sign = index_vectors()
    out = np.zeros((BUCKETS, DIM), np.float32)
    for k in range(ONES):
        np.add.at(out, (np.arange(BUCKETS), place[:, k]), sign[:, k])
    return out


def buckets(text: str) -> np.ndarray:
    """The bucket of every token, in order."""
    tokens = _TOKEN.findall(text)
    known = {t: bucket(t) for t in set(tokens)}
    return np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))


def context_sums(texts: Iterator[str]) -> np.ndarray:
    """Sums of the neighbours' permuted index vectors for each bucket."""
    place, sign = index_vectors()
    out = np.zeros(BUCKETS * DIM)
    for text in texts:
        ids = buckets(text)
        for step in range(1, REACH + 1):
            for a, b, turn in ((ids[:-step], ids[step:], step), (ids[step:], ids[:-step], -step)):
                for at in range(0, len(a), SLICE):
                    cell = (a[at : at + SLICE, None] * DIM + (place[b[at : at + SLICE]] + turn) % DIM).ravel()
                    np.add.at(out, cell, sign[b[at : at + SLICE]].ravel())
    return out.reshape(BUCKETS, DIM)


def pooled(text: str, index: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Means of index and context vectors over the text's tokens, deviations of context vectors, and the mean product of index
    vectors at each step; zeros without tokens."""
    ids = buckets(text)
    out = np.zeros((3 + REACH, index.shape[1]))
    held, times = np.unique(ids, return_counts=True)
    for at in range(0, len(held), SLICE):
        which, n = held[at : at + SLICE], times[at : at + SLICE].astype(np.float32)
        for k, v in enumerate((index[which], context[which], context[which] ** 2)):
            out[k] += n @ v
    out[:3] /= max(len(ids), 1)
    out[2] = np.sqrt(np.maximum(out[2] - out[1] ** 2, 0))
    for step in range(1, min(REACH, len(ids) - 1) + 1):
        a, b = ids[:-step], ids[step:]
        for at in range(0, len(a), SLICE):
            out[2 + step] += np.einsum("ij,ij->j", index[a[at : at + SLICE]], index[b[at : at + SLICE]])
        out[2 + step] /= len(a)
    return out.astype(np.float32).ravel()


@dataclass
class Network:
    """Standardised inputs, a hidden layer of rectified units, one logit, a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def gradients(p: Sequence[np.ndarray], z: np.ndarray, t: np.ndarray) -> list[np.ndarray]:
    """Of the mean log loss, with the weights' decay, by the layers' weights and biases p."""
    h = np.maximum(z @ p[0] + p[1], 0)
    g = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - t) / len(t)
    back = np.outer(g, p[2]) * (h > 0)
    return [z.T @ back + DECAY * p[0], back.sum(axis=0), h.T @ g + DECAY * p[2], g.sum(keepdims=True)]


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 1) -> Network:
    """Adam on the log loss of four fifths of the rows; the temperature is the best on the last fifth."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    apart = order[: len(y) // 5]
    fit = order[len(y) // 5 :]
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
    net = Network(mean, scale, rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), 0.0)
    p = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    z, t = (x - mean) / scale, y.astype(np.float64)
    for epoch in range(EPOCHS):
        rng.shuffle(fit)
        for at in range(0, len(fit), BATCH):
            i = fit[at : at + BATCH]
            grads = gradients(p, z[i], t[i])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) + 1e-5
            for k, d in enumerate(grads):
                first[k] += 0.1 * (d - first[k])
                second[k] += 0.001 * (d * d - second[k])
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = p[0], p[1], p[2], float(p[3][0])
    if len(apart):
        logit, truth = net.logits(x[apart]), t[apart]

        def loss(temperature: float) -> float:
            v = logit / temperature
            return float(np.mean(np.logaddexp(0, v) - truth * v))

        net.temperature = min(np.geomspace(0.25, 8, 61), key=loss)
    return net


@dataclass
class QualityModel:
    context: np.ndarray
    network: Network

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        return self.network.probabilities(np.stack([pooled(t, index_matrix(), self.context) for t in texts]))


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "quality", text_col: str = "text", id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> QualityModel | None:
    """Fit on labelled documents where ``train`` (a condition on the labels' id column, named ``id``) holds; None without
    labelled rows of both kinds."""
    known = labelled(labels, id_col, label_col).where(train)
    sample = drawn(known, "id", sample_rows, "quality")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    rows, path = materialise(texts.join(F.broadcast(sample), "id").select("body", "label").repartition(TASKS), "quality-sample")  # sample_rows bounds the broadcast

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = context_sums(t for batch in text_slices(batches) for t in batch.column(0).to_pylist()).astype(np.float32)
        for r, part in enumerate(np.split(total, RANGES)):
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["r", "v"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v, np.float32) for v in pdf["v"]], axis=0, dtype=np.float32)
        return pd.DataFrame({"r": pdf["r"].iloc[:1], "v": [total.tobytes()]})

    parts = rows.select("body").mapInArrow(sums, "r int, v binary").groupBy("r").applyInPandas(add, "r int, v binary").collect()
    context = np.zeros((RANGES, BUCKETS // RANGES, DIM), np.float32)
    for p in parts:
        context[p.r] = np.frombuffer(p.v, np.float32).reshape(BUCKETS // RANGES, DIM)
    context = context.reshape(BUCKETS, DIM)
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-6)
    sent = docs.sparkSession.sparkContext.broadcast(context)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            made = [pooled(t, index_matrix(), sent.value).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()), batch.column(1)], names=["x", "label"])

    got = rows.select("body", "label").mapInArrow(pool, "x binary, label int").toArrow()
    sent.destroy()
    discard(docs.sparkSession, path)
    y = got.column("label").to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    raw = got.column("x").to_pylist()
    order = sorted(range(len(raw)), key=lambda i: (raw[i], y[i]))  # whatever order the rows came in
    x = np.stack([np.frombuffer(raw[i], np.float32) for i in order]).astype(np.float64)
    return QualityModel(context, fit_network(x, y[order]))


def score_quality(docs: DataFrame, model: QualityModel | None, text_col: str = "text", keep: Sequence[str] = ("doc_id",), cut: float = CUT) -> DataFrame:
    """The ``keep`` columns, ``score`` double (probability of good quality) and ``predicted`` int (1 from ``cut`` on) of every
    whole text. Null is ''; texts without tokens get the score of the pooled zeros; without a model all scores are 0.5.
    Other columns are ignored; repeated rows come back each."""
    require(docs, text_col, *keep)
    if clash := {k.lower() for k in keep} & {"score", "predicted"}:
        raise ValueError(f"kept columns named as results: {', '.join(sorted(clash))}")
    keep = list(keep)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*(docs.schema[k] for k in keep), T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            p = sent.value.scores(texts) if sent.value is not None else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(p), pa.array((p >= cut).astype(np.int32))], names=[*keep, "score", "predicted"])

    return docs.select(*keep, text_col).mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: QualityModel | None, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """Documents, all columns whatever their names, that the model does not reject; all of them without a model."""
    if model is None:
        return docs
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text_col).alias("text"))
    return score_quality(packed, model, keep=["row"], cut=cut).where(F.col("predicted") == 1).select(*[F.col(f"row.`{c}`").alias(c) for c in names])
