"""Secret scans: a character convolutional network over every candidate and its context, beside three plain rules.

The rules (:func:`base_spans`) find assignments, access keys and long hex strings; what they find stays. Candidates are all
maximal runs of ``[A-Za-z0-9+/_.=-]`` of ``LEAST_RUN`` characters or more. A candidate is read as a window: ``CONTEXT``
characters before it, all of it, and as many behind it. The network looks up an embedding of each character, runs one
convolution of ``WIDTH`` characters with ``FILTERS`` filters, pools (greatest over the candidate, mean over it, greatest over
the context) and gives a logit a kind. Windows of any length are laid end to end and run through in pieces, so memory does not
grow with a candidate.

It is trained on labelled findings: windows with one 0/1 label a kind. Where no hand-labelled findings are given,
:func:`rule_findings` takes them from the rules themselves over all documents; while training, the letters of
half of the contexts are hidden, so that a value must look like a secret by itself, and not only stand behind the rules' words.
A third of the findings is held back: on all of it each kind's logits are calibrated (Platt, findings weighted by how frequent
they are), and the kind's threshold is the highest one that still finds ``RECALL`` of the held-back positives. A kind with
fewer than ``LEAST_POSITIVES`` of them has no threshold and adds nothing. Training is stochastic gradient descent: its ``STEPS``
minibatches are drawn from the other findings, of which no more are fetched than all minibatches together have places.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import require, text_slices

# The rules of the scan.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
#: Characters of a candidate at least.
LEAST_RUN = 12
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % LEAST_RUN)

CONTEXT, WIDTH, FILTERS, EMBEDDING = 24, 7, 24, 8
HALF = WIDTH // 2
#: A training window's candidate is cut to so many characters from its middle.
TRAIN_RUN = 256
STEPS, BATCH, RATE, DECAY, MOST_NORM = 400, 32, 0.003, 1e-4, 1.0
#: Held-back logits, between -MOST_LOGIT and MOST_LOGIT, are counted by steps of 1 / LOGIT_STEPS, rounded down.
MOST_LOGIT, LOGIT_STEPS = 40, 256
RECALL, LEAST_POSITIVES = 0.99, 10
#: Characters that are run through the network at once.
PIECE = 1 << 15

# Codes: 0 is padding, 1 to 95 printable ASCII, 96 control characters, 97 everything else.
CODES = 98
_HIDDEN = 97


def codes_of(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(raw > 126, 97, np.where(raw < 32, 96, raw - 31)).astype(np.uint8)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """What the rules find: (start, kind, end), ascending. Matches of a kind do not overlap; those that are too short are
    dropped, and what they covered is not looked at again."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= LEAST_VALUE]
    # access keys and hex strings lie within runs of a candidate's characters, and are no shorter than candidates are
    for run in RUN.finditer(text):
        at, end = run.span()
        if end - at >= LEAST_ACCESS:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, at, end) if m.end() - m.start() >= LEAST_ACCESS]
        if end - at >= LEAST_HEX:
            found += [(m.start(), 2, m.end()) for m in HEX.finditer(text, at, end) if m.end() - m.start() >= LEAST_HEX]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    """All candidates of a text: (start, end)."""
    return [m.span() for m in RUN.finditer(text)]


def rule_labels(runs: Sequence[tuple[int, int]], spans: Sequence[tuple[int, int, int]]) -> np.ndarray:
    """By candidate, a bit for each kind of which a span overlaps it; both are ascending by start."""
    out = np.zeros(len(runs), np.int64)
    starts = np.array([a for a, _ in runs], np.int64)
    ends = np.array([b for _, b in runs], np.int64)
    for at, kind, end in spans:
        out[np.searchsorted(ends, at, "right") : np.searchsorted(starts, end, "left")] |= 1 << kind
    return out


def window(codes: np.ndarray, start: int, end: int, most: int | None = None) -> np.ndarray:
    """The codes of a candidate between its contexts, all padded to their full length; ``most``: only so many of the
    candidate's from its middle."""
    if most is not None and end - start > most:
        start += (end - start - most) // 2
        end = start + most
    left, right = codes[max(0, start - CONTEXT) : start], codes[end : end + CONTEXT]
    side = CONTEXT + HALF
    return np.concatenate([np.zeros(side - len(left), np.uint8), left, codes[start:end], right, np.zeros(side - len(right), np.uint8)])


@dataclass
class CharNet:
    """embedding (CODES, E) whose row 0 stays 0; kernel (WIDTH * (E + 1), F) over embeddings and a mark of the candidate;
    out (3 F, kinds)."""

    embedding: np.ndarray
    kernel: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    #: Platt's slope and offset of each kind, and its threshold on the calibrated probability; above 1: none.
    slope: np.ndarray = field(default_factory=lambda: np.ones(len(KINDS)))
    offset: np.ndarray = field(default_factory=lambda: np.zeros(len(KINDS)))
    threshold: np.ndarray = field(default_factory=lambda: np.full(len(KINDS), 2.0))

    @classmethod
    def new(cls, seed: int = 7) -> CharNet:
        rng = np.random.default_rng(seed)
        embedding = rng.normal(0, 0.5, (CODES, EMBEDDING))
        embedding[0] = 0
        fan = WIDTH * (EMBEDDING + 1)
        return cls(embedding, rng.normal(0, (2 / fan) ** 0.5, (fan, FILTERS)), np.zeros(FILTERS), rng.normal(0, (1 / FILTERS) ** 0.5 / 3, (3 * FILTERS, len(KINDS))), np.zeros(len(KINDS)))

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.kernel, self.shift, self.out, self.bias]

    def columns(self, codes: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """For every place but the first and last HALF, the inputs under the kernel."""
        x = np.concatenate([self.embedding[codes], mark[:, None]], axis=1)
        return np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=0).transpose(0, 2, 1).reshape(len(x) - WIDTH + 1, -1)

    def logits(self, windows: Sequence[np.ndarray]) -> np.ndarray:
        """A row for each window, pieces of all of them at a time."""
        n = len(windows)
        if not n:
            return np.zeros((0, len(KINDS)))
        codes, mark, starts = layout(windows)
        segment = np.searchsorted(starts, np.arange(len(codes)), "right") - 1
        most, total = np.zeros((3 * n, FILTERS)), np.zeros((3 * n, FILTERS))
        padded = np.concatenate([np.zeros(HALF, np.uint8), codes, np.zeros(HALF, np.uint8)])
        marked = np.concatenate([np.zeros(HALF), mark, np.zeros(HALF)])
        for at in range(0, len(codes), PIECE):
            to = min(len(codes), at + PIECE)
            h = np.maximum(self.columns(padded[at : to + 2 * HALF], marked[at : to + 2 * HALF]) @ self.kernel + self.shift, 0)
            own = segment[at:to]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            most[own[first]] = np.maximum(most[own[first]], np.maximum.reduceat(h, first))
            total[own[first]] += np.add.reduceat(h, first)
        return pooled(most, total, starts, len(codes)) @ self.out + self.bias

    def probabilities(self, windows: Sequence[np.ndarray]) -> np.ndarray:
        return sigmoid(self.logits(windows) * self.slope + self.offset)


def sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))


def layout(windows: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows end to end: codes, the mark of candidates, and where each one's three segments begin."""
    side = CONTEXT + HALF
    sizes = np.array([len(w) for w in windows], np.int64)
    begin = np.cumsum(sizes) - sizes
    starts = np.stack([begin, begin + side, begin + sizes - side], axis=1).ravel()
    mark = np.zeros(int(sizes.sum()) + 1)
    mark[begin + side] += 1
    mark[begin + sizes - side] -= 1
    return np.concatenate(windows), np.cumsum(mark)[:-1], starts


def pooled(most: np.ndarray, total: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
    """Greatest and mean over each candidate, greatest over its context."""
    sizes = np.diff(np.r_[starts, end])[1::3, None]
    return np.concatenate([most[1::3], total[1::3] / sizes, np.maximum(most[0::3], most[2::3])], axis=1)


def loss_and_gradient(net: CharNet, windows: Sequence[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """The weighted mean log loss over windows and kinds, and its gradient by each parameter."""
    codes, mark, starts = layout(windows)
    n, end = len(windows), len(codes)
    x = net.columns(np.r_[np.zeros(HALF, np.uint8), codes, np.zeros(HALF, np.uint8)], np.r_[np.zeros(HALF), mark, np.zeros(HALF)])
    h = np.maximum(x @ net.kernel + net.shift, 0)
    sizes = np.diff(np.r_[starts, end])
    most, total = np.maximum.reduceat(h, starts), np.add.reduceat(h, starts)
    f = pooled(most, total, starts, end)
    v = f @ net.out + net.bias
    w = weights[:, None] / weights.sum() / len(KINDS)
    loss = float((w * (np.logaddexp(0, v) - labels * v)).sum())
    dv = w * (sigmoid(v) - labels)
    df = dv @ net.out.T
    # a greatest value's gradient goes to the places that reach it, in equal parts
    left = most[0::3] >= most[2::3]
    to_most = np.zeros_like(most)
    to_most[1::3] = df[:, :FILTERS]
    to_most[0::3], to_most[2::3] = np.where(left, df[:, 2 * FILTERS :], 0), np.where(left, 0, df[:, 2 * FILTERS :])
    to_mean = np.zeros_like(most)
    to_mean[1::3] = df[:, FILTERS : 2 * FILTERS] / sizes[1::3, None]
    top = h == np.repeat(most, sizes, axis=0)
    shared = to_most / np.add.reduceat(top, starts).astype(float)
    dh = np.where(h > 0, np.repeat(to_mean, sizes, axis=0) + top * np.repeat(shared, sizes, axis=0), 0)
    dx = (dh @ net.kernel.T).reshape(end, WIDTH, EMBEDDING + 1)[:, :, :EMBEDDING]
    at_place = np.zeros((end + 2 * HALF, EMBEDDING))
    for k in range(WIDTH):
        at_place[k : k + end] += dx[:, k]
    d_embedding = np.stack([np.bincount(codes, weights=at_place[HALF : HALF + end, e], minlength=CODES) for e in range(EMBEDDING)], axis=1)
    d_embedding[0] = 0
    return loss, [d_embedding, x.T @ dh, dh.sum(axis=0), f.T @ dv, dv.sum(axis=0)]


def hide_letters(w: np.ndarray) -> np.ndarray:
    """A window whose context has no letters any more."""
    side = CONTEXT + HALF
    letter = ((w >= 34) & (w <= 59)) | ((w >= 66) & (w <= 91))
    letter[side:-side] = False
    return np.where(letter, np.uint8(_HIDDEN), w)


def platt(v: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and offset that fit labels y of weights w best by log loss; Newton's method, held near (1, 0)."""
    theta = np.array([1.0, 0.0])
    x = np.stack([v, np.ones_like(v)], axis=1)
    hold = 1e-3 * w.sum()
    for _ in range(50):
        p = sigmoid(x @ theta)
        grad = x.T @ (w * (p - y)) + hold * (theta - (1, 0))
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + hold * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta = theta - step
        theta[0] = max(theta[0], 0.05)
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def recall_threshold(p: np.ndarray, y: np.ndarray, recall: float) -> float:
    """The highest threshold at which this share of the positives is found; above 1 with too few positives."""
    found = np.sort(p[y > 0])[::-1]
    if len(found) < LEAST_POSITIVES:
        return 2.0
    return float(found[int(np.ceil(recall * len(found))) - 1])


def train(windows: Sequence[np.ndarray], labels: np.ndarray, steps: int = STEPS, seed: int = 7) -> CharNet:
    """A network trained on these findings by minibatches, BATCH of either side."""
    net = CharNet.new(seed)
    rng = np.random.default_rng(seed)
    params = net.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    positive = labels.any(axis=1)
    sides = [x for x in (np.flatnonzero(positive), np.flatnonzero(~positive)) if len(x)]
    for step in range(1, steps + 1):
        # either side counts alike, whatever its number
        chosen = np.concatenate([rng.choice(side, BATCH) for side in sides])
        batch = [hide_letters(windows[i]) if hidden else windows[i] for i, hidden in zip(chosen, rng.random(len(chosen)) < 0.5, strict=True)]
        _, grads = loss_and_gradient(net, batch, labels[chosen], np.ones(len(chosen)))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        for p, g, m, s in zip(params, grads, first, second, strict=True):
            g = g * min(1.0, MOST_NORM / max(norm, 1e-12)) + DECAY * p
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def fit_findings(windows: Sequence[np.ndarray], labels: np.ndarray, weights: np.ndarray, recall: float = RECALL, steps: int = STEPS, seed: int = 7) -> CharNet | None:
    """Train, calibrate and set thresholds. labels: (findings, kinds) of 0 or 1; weights: how many candidates of the corpus a
    finding stands for. None without a positive."""
    if not len(windows) or not labels.any():
        return None
    held = np.array([zlib.crc32(w.tobytes()) % 3 == 0 for w in windows])
    if not labels[~held].any():
        held[:] = False
    own = np.flatnonzero(~held)
    net = train([windows[i] for i in own], labels[own], steps, seed)
    tuned = np.flatnonzero(held) if held.any() else own
    v = net.logits([windows[i] for i in tuned])
    for k in range(len(KINDS)):
        calibrate(net, k, v[:, k], labels[tuned, k], weights[tuned], np.ones(len(tuned)), recall)
    return net


def calibrate(net: CharNet, kind: int, v: np.ndarray, y: np.ndarray, weight: np.ndarray, n: np.ndarray, recall: float) -> None:
    """Set a kind's slope, offset and threshold by held-back logits v, each of n findings that stand for ``weight`` candidates."""
    if y.any():
        net.slope[kind], net.offset[kind] = platt(v, y, weight)
        p = sigmoid(v * net.slope[kind] + net.offset[kind])
        net.threshold[kind] = recall_threshold(np.repeat(p, n.astype(np.int64)), np.repeat(y, n.astype(np.int64)), recall)


def rule_findings(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct windows of all candidates of all documents, with the kinds that the rules find there (a bit each) and how many
    candidates have the window: window, kinds, n."""
    texts = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            windows, kinds = [], []
            for text in batch.column(0).to_pylist():
                runs = candidates(text)
                if runs:
                    codes = codes_of(text)
                    windows += [window(codes, a, b, TRAIN_RUN).tobytes() for a, b in runs]
                    kinds += rule_labels(runs, base_spans(text)).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.binary()), pa.array(kinds, pa.int64())], names=["window", "kinds"])

    return texts.mapInArrow(found, "window binary, kinds bigint").groupBy("window").agg(F.bit_or("kinds").alias("kinds"), F.count("*").alias("n"))


def held_logits(findings: DataFrame, net: CharNet) -> DataFrame:
    """How the network scores findings: step (its logit, rounded down to a LOGIT_STEPS-th), kind, label, how many findings
    (``n``) and candidates (``weight``) there are; a bounded number of rows, whatever the number of findings."""
    sent = findings.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                v = sent.value.logits([np.frombuffer(w, np.uint8) for w in batch.column(0).to_pylist()])
                step = np.floor(np.clip(v, -MOST_LOGIT, MOST_LOGIT) * LOGIT_STEPS).astype(np.int64)
                label = batch.column(1).to_numpy()[:, None] >> np.arange(len(KINDS)) & 1
                kind = np.tile(np.arange(len(KINDS)), len(v))
                columns = [pa.array(step.ravel()), pa.array(kind), pa.array(label.ravel()), pa.array(np.repeat(batch.column(2).to_numpy(), len(KINDS)))]
                yield pa.RecordBatch.from_arrays(columns, names=["step", "kind", "label", "w"])

    scored = findings.select("window", "kinds", "n").mapInArrow(run, "step bigint, kind bigint, label bigint, w bigint")
    return scored.groupBy("step", "kind", "label").agg(F.count("*").alias("n"), F.sum("w").alias("weight"))


def fit_secrets(findings: DataFrame, recall: float = RECALL) -> CharNet | None:
    """Fit on labelled findings (window, kinds, n). Minibatches are drawn, by a hash of the window, from those that are not held
    back; calibration and thresholds are of all that are, or, where none is, of all findings."""
    labelled = findings.select("window", "kinds", "n", F.xxhash64(F.lit("finding"), "window").alias("h"), (F.crc32("window") % 3 == 0).alias("held")).persist()
    try:
        told = {(r.held, r.positive): r["count"] for r in labelled.groupBy("held", (F.col("kinds") != 0).alias("positive")).count().collect()}
        if not any(positive for _, positive in told):
            return None
        apart = (False, True) in told  # else even what is held back is trained on
        rows = []
        for side in (True, False):
            n = told.get((False, side), 0) + (0 if apart else told.get((True, side), 0))
            chosen = labelled.where((F.col("kinds") != 0) == side)
            chosen = chosen.where("NOT held") if apart else chosen
            if n > STEPS * BATCH:
                chosen = chosen.where(F.col("h") < F.lit(-(2**63) + 2**64 * STEPS * BATCH // n))
            rows += [(r["window"], r["kinds"]) for r in chosen.select("window", "kinds").toArrow().to_pylist()]
        rows.sort()
        kinds = np.array([r[1] for r in rows], np.int64)
        net = train([np.frombuffer(r[0], np.uint8) for r in rows], (kinds[:, None] >> np.arange(len(KINDS)) & 1).astype(float))
        tuned = labelled.where("held") if apart and any(held for held, _ in told) else labelled
        scored = held_logits(tuned, net).toArrow().sort_by([("step", "ascending"), ("label", "ascending")])
    finally:
        labelled.unpersist()
    step, kind, label, n, weight = (scored.column(c).to_numpy() for c in ("step", "kind", "label", "n", "weight"))
    for k in range(len(KINDS)):
        own = kind == k
        calibrate(net, k, step[own] / LOGIT_STEPS, label[own].astype(float), weight[own].astype(float), n[own], recall)
    return net


def scan(texts: Sequence[str], net: CharNet | None) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Of each text the rules' spans and those that the network adds: (start, kind, end)."""
    out, windows, places = [], [], []
    for i, text in enumerate(texts):
        runs = candidates(text)
        base = base_spans(text)
        out.append((base, []))
        if runs and net is not None:
            has = rule_labels(runs, base)
            codes = codes_of(text)
            windows += [window(codes, a, b) for a, b in runs]
            places += [(i, a, b, h) for (a, b), h in zip(runs, has.tolist(), strict=True)]
    if windows:
        sure = net.probabilities(windows) >= net.threshold
        for j in np.flatnonzero(sure.any(axis=1)).tolist():
            i, a, b, h = places[j]
            out[i][1].extend((a, k, b) for k in range(len(KINDS)) if sure[j, k] and not h >> k & 1)
    return out


def told(spans: Sequence[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame, net: CharNet | None, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and, of every whole text, ``n_assign``, ``n_access``, ``n_hex`` (what the rules find), ``base_spans``
    and ``spans`` (all of them) as kind:start:end by start, then kind, comma-joined; offsets in code points, end exclusive.

    Null is ''; without a model only the rules' spans come back. A candidate of any length is read whole. Other columns are
    ignored, whatever their names; repeated rows come back each; an empty table gives an empty one.
    """
    require(docs, text_col, *keep)
    results = {"n_assign": T.LongType(), "n_access": T.LongType(), "n_hex": T.LongType(), "base_spans": T.StringType(), "spans": T.StringType()}
    if clash := {k.lower() for k in keep} & set(results):
        raise ValueError(f"kept columns named as results: {', '.join(sorted(clash))}")
    keep = list(keep)
    sent = docs.sparkSession.sparkContext.broadcast(net)
    schema = T.StructType([*(docs.schema[k] for k in keep), *(T.StructField(k, t, False) for k, t in results.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = scan([t or "" for t in batch.column(len(keep)).to_pylist()], sent.value)
            counts = [pa.array([sum(k == kind for _, k, _ in base) for base, _ in found], pa.int64()) for kind in range(len(KINDS))]
            spans = [pa.array([told(base) for base, _ in found], pa.string()), pa.array([told(sorted(base + more)) for base, more in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *counts, *spans], names=[*keep, *results])

    return docs.select(*[F.col(f"`{k}`") for k in keep], F.col(f"`{text_col}`")).mapInArrow(run, schema)
