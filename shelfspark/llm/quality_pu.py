"""Quality classifier by positive-unlabelled learning.

Documents labelled good are the trusted positives, documents without a label
the unlabelled web text. A small network over text statistics is fitted by the
non-negative unbiased risk: with class prior p,

    p * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - p * E_pos[loss(-f)])

with the sigmoid loss; where the second part is negative, its gradient is
reversed. The prior is estimated beforehand: a classifier of positives against
unlabelled ranks texts, and the prior is the least ratio, over all thresholds,
of the shares of unlabelled and positive texts (of a part not fitted on) above
the threshold, each with its margin of error.

Bounds of the fit: ``SAMPLE_DOCS`` positives and twice as many unlabelled
documents. Negative labels are not used.

Defined cases: null, empty and white-space texts have all statistics 0 and get
a score like any other; repeated rows are scored one by one; without positives
or unlabelled rows the score is 0.5 for all; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import Shared
from shelfspark.llm.quality_rules import SPACE, SYMBOLS, base_counts
from shelfspark.llm.sampling import bounded_sample

SAMPLE_DOCS = 4000
HIDDEN = 16
EPOCHS = 60
BATCH = 500
RATE = 0.01
SEED = 8

_UPPER = re.compile(r"[^\W\d_a-z\xdf-\xf6\xf8-\xff]")


def features(text: str | None) -> list[float]:
    """Statistics of a whole text; each is bounded or grows with the logarithm of its length."""
    text = text or ""
    n_words, chars, symbols, dup_lines, repeated, n_lines = base_counts(text)
    if not n_words:
        return [0.0] * N_FEATURES
    words = text.split()
    w, c = max(1, len(words)), max(1, chars)
    lower = [x.lower() for x in words]
    distinct = len(set(lower))
    bare = [len(x) for x in words]
    ends = sum(x[-1] in ".,;:?" for x in words)
    return [
        np.log1p(w), np.log1p(n_lines), symbols / c, min(1.0, symbols / w), text.count("!") / c,
        text.count("|") / w, len(_UPPER.findall(text)) / c, sum(x.isupper() for x in words) / w,
        sum(x.isdigit() for x in words) / w, chars / max(1, n_words) / 10, sum(b <= 3 for b in bare) / w,
        sum(b >= 9 for b in bare) / w, distinct / w, np.log(distinct) / max(1.0, np.log(w)),
        sum(a == b for a, b in zip(lower, lower[1:])) / w, repeated / max(1, n_words),
        dup_lines / max(1, n_lines), ends / w, text.count(".") / w, text.count(",") / w,
        1.0 if text.rstrip()[-1:] in ".!?\"" else 0.0, np.log1p(w / max(1, n_lines)),
    ]


N_FEATURES = 22


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """One hidden layer over standardised statistics; Adam steps."""

    def __init__(self, n: int, hidden: int, rng):
        self.p = [rng.normal(0, n ** -0.5, (n, hidden)), np.zeros(hidden),
                  rng.normal(0, hidden ** -0.5, hidden), np.zeros(1)]
        self.m = [np.zeros_like(x) for x in self.p]
        self.v = [np.zeros_like(x) for x in self.p]
        self.t = 0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        w, b, o, c = self.p
        return np.tanh(x @ w + b) @ o + c[0]

    def step(self, x: np.ndarray, slope: np.ndarray, rate: float, decay: float = 1e-4) -> None:
        """``slope``: derivative of the risk by each row's output."""
        w, b, o, _ = self.p
        h = np.tanh(x @ w + b)
        back = slope[:, None] * o * (1 - h * h)
        grads = [x.T @ back, back.sum(0), h.T @ slope, slope.sum(keepdims=True)]
        self.t += 1
        for k, g in enumerate(grads):
            g = g + decay * self.p[k]
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            self.p[k] = self.p[k] - rate * (self.m[k] / (1 - 0.9 ** self.t)) / (
                np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)


def _batches(rng, pos, unl, epochs):
    n = max(1, len(unl) // BATCH)
    for _ in range(epochs):
        for u in np.array_split(rng.permutation(len(unl)), n):
            yield rng.integers(0, len(pos), max(1, len(u) // 2)), u


def estimate_prior(pos: np.ndarray, unl: np.ndarray, rng) -> float:
    """Share of positives among the unlabelled: least ratio of the shares above a threshold."""
    a, b = len(pos) // 2, len(unl) // 2
    net = Network(pos.shape[1], HIDDEN, rng)
    for p, u in _batches(rng, pos[:a], unl[:b], 20):
        x = np.concatenate([pos[p], unl[u]])
        s = _sigmoid(net(x))
        y = np.concatenate([np.ones(len(p)), np.zeros(len(u))])
        weight = np.concatenate([np.full(len(p), 0.5 / len(p)), np.full(len(u), 0.5 / len(u))])
        net.step(x, weight * (s - y), RATE)
    sp, su = np.sort(net(pos[a:])), np.sort(net(unl[b:]))
    at = np.unique(np.concatenate([sp, su]))
    above_p = 1 - np.searchsorted(sp, at) / len(sp)
    above_u = 1 - np.searchsorted(su, at) / len(su)
    error = np.sqrt(np.log(20) / 2) * (len(sp) ** -0.5 + len(su) ** -0.5)
    use = above_p > 0
    bound = above_u[use] / above_p[use] + error / above_p[use]
    best = int(np.argmin(bound))
    return float(np.clip(above_u[use][best] / above_p[use][best], 0.01, 0.99))


class Model:
    def __init__(self, centre, scale, prior, net):
        self.centre, self.scale, self.prior, self.net = centre, scale, prior, net

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.net is None:
            return np.full(len(rows), 0.5)
        x = np.clip((rows - self.centre) / self.scale, -8, 8)
        return _sigmoid(self.net(x))


def fit_rows(pos: np.ndarray, unl: np.ndarray, prior: float | None = None) -> Model:
    """Fit on statistics of positives and unlabelled rows."""
    if len(pos) < 4 or len(unl) < 4:
        return Model(0, 1, prior, None)
    rng = np.random.default_rng(SEED)
    centre = unl.mean(0)
    scale = unl.std(0) + 1e-3
    pos, unl = (np.clip((x - centre) / scale, -8, 8) for x in (pos, unl))
    pos, unl = rng.permutation(pos), rng.permutation(unl)
    if prior is None:
        prior = estimate_prior(pos, unl, rng)
    net = Network(pos.shape[1], HIDDEN, rng)
    steps = max(1, 600 // max(1, len(unl) // BATCH))
    for p, u in _batches(rng, pos, unl, max(EPOCHS, steps)):
        sp, su = _sigmoid(net(pos[p])), _sigmoid(net(unl[u]))
        # loss(f) = sigmoid(-f); d loss(f)/df = -s(1-s), d loss(-f)/df = s(1-s)
        dp, du = sp * (1 - sp) / len(p), su * (1 - su) / len(u)
        negative = su.mean() - prior * sp.mean()
        if negative >= 0:
            net.step(np.concatenate([pos[p], unl[u]]),
                     np.concatenate([-prior * dp - prior * dp, du]), RATE)
        else:
            net.step(np.concatenate([pos[p], unl[u]]), np.concatenate([prior * dp, -du]), RATE)
    return Model(centre, scale, prior, net)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality) of the rows to learn from."""
    good = labels.filter("quality = 1").select("doc_id").distinct()
    ids = docs.select("doc_id").join(good.withColumn("positive", F.lit(1)), "doc_id", "left")
    known = labels.select("doc_id").distinct().withColumn("known", F.lit(1))
    ids = (ids.join(known, "doc_id", "left").filter("doc_id is not null")
           .filter("positive = 1 or known is null")
           .select("doc_id", F.coalesce("positive", F.lit(0)).alias("positive")))
    pos = bounded_sample(ids.filter("positive = 1"), "positive", SAMPLE_DOCS)["doc_id"].to_pylist()
    unl = bounded_sample(ids.filter("positive = 0"), "positive", 2 * SAMPLE_DOCS)["doc_id"].to_pylist()
    # at most 1.5 * 3 * SAMPLE_DOCS ids, so the list has a fixed bound
    wanted = docs.sparkSession.createDataFrame(
        pa.table({"doc_id": pa.array(pos + unl, pa.int64()),
                  "positive": pa.array([1] * len(pos) + [0] * len(unl), pa.int32())}))
    got = (docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")
           .mapInArrow(_featured(["doc_id", "positive"]), "doc_id long, positive int, x array<double>").toArrow())
    x = np.array(got["x"].to_pylist(), float).reshape(-1, N_FEATURES)
    order = np.argsort(got["doc_id"].to_numpy(), kind="stable")
    positive = got["positive"].to_numpy()[order] == 1
    return fit_rows(x[order][positive], x[order][~positive])


def _featured(keep: list[str]):
    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            x = [features(texts[i].as_py()) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(x, pa.list_(pa.float64()))], [*keep, "x"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (above 0.5: rather good) of every document."""
    shared = Shared(docs.sparkSession, model)

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            x = np.array([features(texts[i].as_py()) for i in range(len(texts))], float).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(shared.value.scores(x))], ["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``; rows are judged where they lie."""
    shared = Shared(docs.sparkSession, model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(at)
            x = np.array([features(texts[i].as_py()) for i in range(len(texts))], float).reshape(-1, N_FEATURES)
            yield batch.filter(pa.array(shared.value.scores(x) >= threshold))
    return docs.mapInArrow(run, docs.schema)
