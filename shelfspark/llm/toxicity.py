"""Toxicity scores from a bidirectional gated recurrent network, in numpy.

Words stand between white space. A character of a script that is written without
blanks is a word of its own; a word of more than ``WORD_CHARS`` characters is
read in pieces that overlap by one character less than the longest n-gram.
A word's input is the sum of a word embedding (hashed) and the embeddings of
its character n-grams (hashed, with its start and end marked), so unseen forms
of a stem are recognised. Two gated recurrent units read a window of words, one
in each direction; attention weights their states and a logistic output gives
the window's score. A text is cut into windows that overlap by a quarter,
all of them are scored, and the text's score is that of its worst window.

Training: windows inherit their text's label; per text the window that scores
highest learns (a text is toxic if one window is). Embeddings start with the
smoothed log odds of their feature on the training texts in one coordinate.
Bounds: ``SAMPLE_DOCS`` texts per label, ``TRAIN_WINDOWS`` windows of a long
text, of evenly spaced places. Scoring reads every window of every text.

Defined cases: null, empty and white-space texts have one empty window, whose
score is that of the output's bias; repeated rows are scored one by one; without
both labels the score is 0 for all; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import Shared
from shelfspark.llm.sampling import bounded_sample

SAMPLE_DOCS = 2000
TRAIN_WINDOWS = 24
WINDOW = 32
STRIDE = 24
EMBED = 12
HIDDEN = 8
WORD_BUCKETS = 1 << 16
GRAM_BUCKETS = 1 << 15
EPOCHS = 4
#: Steps that a small sample is trained for, in more epochs.
MIN_STEPS = 120
BATCH = 128
SEED = 3
#: Words whose inputs a worker remembers.
CACHED_WORDS = 200_000

#: Longest word; a longer one is cut into pieces of this length.
WORD_CHARS = 60
GRAMS = (3, 4, 5)
# Thai, Lao, Tibetan, Myanmar, Khmer, kana, Chinese characters, and their extensions
_UNSPACED = "\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff" \
            "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff"
_OF_UNSPACED = re.compile(f"[{_UNSPACED}]")
_RUN = re.compile(f"[{_UNSPACED}]|[^{_UNSPACED}]+")

_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    words = text.split()
    unspaced = not text.isascii() and _OF_UNSPACED.search(text)
    if not unspaced and max(map(len, words), default=0) <= WORD_CHARS:
        return words
    runs = [r for w in words for r in _RUN.findall(w)] if unspaced else words
    step = WORD_CHARS - GRAMS[-1] + 1
    return [r[a:a + WORD_CHARS] for r in runs for a in range(0, max(1, len(r) - GRAMS[-1] + 1), step)]


_GRAM = np.random.default_rng(5).integers(1, 1 << 63, (6, 5)).astype(np.uint64) | np.uint64(1)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the embedding table, word after word, and their number by word.

    A word's first row is its own, the others are those of its character 3- to 5-grams.
    """
    parts = [_word_features(words[a:a + 10_000]) for a in range(0, len(words), 10_000)] or [_word_features([])]
    return np.concatenate([r for r, _ in parts]), np.concatenate([n for _, n in parts])


def _word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    bare = [w.strip(_EDGE) or w[:1] for w in words]
    own = np.fromiter((xxhash.xxh3_64_intdigest(b.encode("utf-8", "surrogatepass")) % WORD_BUCKETS for b in bare),
                      np.int64, len(bare))
    codes = np.frombuffer("".join(f"<{b}>" for b in bare).encode("utf-32-le", "surrogatepass"),
                          np.uint32).astype(np.uint64)
    length = np.fromiter((len(b) + 2 for b in bare), np.int64, len(bare))
    end = np.repeat(np.cumsum(length), length)
    word = np.repeat(np.arange(len(bare)), length)
    owners, rows = [np.arange(len(bare))], [own]
    for n in GRAMS:
        at = np.flatnonzero(np.arange(len(codes)) + n <= end)
        h = np.zeros(len(at), np.uint64)
        for k in range(n):
            h += codes[at + k] * _GRAM[n, k]
        h ^= h >> np.uint64(29)
        rows.append(((h * _GRAM[0, 0]) >> np.uint64(40)).astype(np.int64) % GRAM_BUCKETS + WORD_BUCKETS)
        owners.append(word[at])
    owner = np.concatenate(owners)
    return (np.concatenate(rows)[np.argsort(owner, kind="stable")].astype(np.int32),
            np.bincount(owner, minlength=len(bare)))


def _sig(x):
    return 0.5 * np.tanh(0.5 * x) + np.float32(0.5)


def window_starts(n: int) -> list[int]:
    """Starts of the windows of a text of n words; each word is in one or two."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


class Network:
    """Parameters, forward pass over windows [windows, words, EMBED], and its gradients."""

    def __init__(self, rng):
        def r(*shape):
            return (rng.normal(0, shape[0] ** -0.5, shape)).astype(np.float32)
        self.p = {"out": np.zeros(2 * HIDDEN, np.float32) + r(2 * HIDDEN) * 0.1,
                  "bias": np.zeros(1, np.float32) - 1, "att": r(2 * HIDDEN, HIDDEN), "query": r(HIDDEN)}
        for d in "fb":
            # gates in the order update, reset, candidate
            self.p |= {f"w{d}": r(EMBED, 3 * HIDDEN), f"u{d}": r(HIDDEN, 2 * HIDDEN),
                       f"v{d}": r(HIDDEN, HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}

    def run(self, gates: dict[str, np.ndarray], mask: np.ndarray, keep: bool = False):
        """``gates``: inputs times w, by direction, time first; ``mask``: words that exist."""
        t, n = mask.shape
        h_all = np.zeros((t, n, 2 * HIDDEN), np.float32)
        tape = {"f": [], "b": []}
        for d, order, at in (("f", range(t), 0), ("b", range(t - 1, -1, -1), HIDDEN)):
            u, v, g = self.p[f"u{d}"], self.p[f"v{d}"], gates[d]
            h = np.zeros((n, HIDDEN), np.float32)
            for k in order:
                x = g[k]
                zr = _sig(x[:, :2 * HIDDEN] + h @ u)
                z, q = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(x[:, 2 * HIDDEN:] + (q * h) @ v)
                new = h + z * (c - h) * mask[k, :, None]
                if keep:
                    tape[d].append((k, h, z, q, c))
                h = new
                h_all[k, :, at:at + HIDDEN] = h
        a = np.tanh(h_all @ self.p["att"])
        e = a @ self.p["query"] - np.float32(1e4) * (1 - mask)
        e = np.exp(e - e.max(0))
        weight = e * mask
        weight /= np.maximum(weight.sum(0), np.float32(1e-9))
        pooled = np.einsum("tn,tnh->nh", weight, h_all)
        score = pooled @ self.p["out"] + self.p["bias"][0]
        return score, (h_all, a, weight, pooled, tape)

    def gradients(self, slope, gates, mask, kept, inputs):
        """Gradients of the parameters and of the inputs for ``slope``, d loss / d score."""
        h_all, a, weight, pooled, tape = kept
        g = {k: np.zeros_like(x) for k, x in self.p.items()}
        g["out"] = pooled.T @ slope
        g["bias"] = slope.sum(keepdims=True)
        dp = slope[:, None] * self.p["out"]
        dh = weight[:, :, None] * dp
        dw = np.einsum("tnh,nh->tn", h_all, dp)
        de = weight * (dw - (weight * dw).sum(0))
        g["query"] = np.einsum("tn,tnk->k", de, a)
        da = de[:, :, None] * self.p["query"] * (1 - a * a)
        g["att"] = np.einsum("tnh,tnk->hk", h_all, da)
        dh += da @ self.p["att"].T
        dx = np.zeros_like(inputs)
        for d, at in (("f", 0), ("b", HIDDEN)):
            u, v, w = self.p[f"u{d}"], self.p[f"v{d}"], self.p[f"w{d}"]
            back = np.zeros((mask.shape[1], HIDDEN), np.float32)
            for k, h, z, q, c in reversed(tape[d]):
                m = mask[k, :, None]
                back = back + dh[k, :, at:at + HIDDEN]
                dz, dc = back * m * (c - h) * z * (1 - z), back * m * z * (1 - c * c)
                dqh = dc @ v.T
                dq = dqh * h * q * (1 - q)
                dzr = np.concatenate([dz, dq], 1)
                g[f"u{d}"] += h.T @ dzr
                g[f"v{d}"] += (q * h).T @ dc
                dgate = np.concatenate([dzr, dc], 1)
                g[f"w{d}"] += inputs[k].T @ dgate
                g[f"c{d}"] += dgate.sum(0)
                dx[k] += dgate @ w.T
                back = back * (1 - z * m) + dqh * q + dzr @ u.T
        return g, dx


class Model:
    """Embedding table and network; scores texts by their worst window."""

    def __init__(self, table: np.ndarray, net: Network | None):
        self.table, self.net = table, net
        self.known: dict[str, int] = {}
        self.gates = {d: np.zeros((1, 3 * HIDDEN), np.float32) for d in "fb"}

    def __getstate__(self):
        return {"table": self.table, "net": self.net}

    def __setstate__(self, state):
        self.__init__(**state)

    def inputs(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, EMBED), np.float32)
        return embed(self.table, *word_features(words))

    def _rows(self, words: set[str]) -> None:
        """Give each word a row of the gates' input table."""
        if len(self.known) > CACHED_WORDS:
            self.known, self.gates = {}, {d: np.zeros((1, 3 * HIDDEN), np.float32) for d in "fb"}
        new = [w for w in words if w not in self.known]
        if new:
            x = self.inputs(new)
            at = len(self.gates["f"])
            self.known.update(zip(new, range(at, at + len(new))))
            self.gates = {d: np.concatenate([self.gates[d], x @ self.net.p[f"w{d}"] + self.net.p[f"c{d}"]])
                          for d in "fb"}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Scores of a block of texts, 0 to 1."""
        if self.net is None:
            return np.zeros(len(texts))
        lists = [words_of(t) for t in texts]
        self._rows(set().union(*lists) if lists else set())
        look = self.known.__getitem__
        best = np.full(len(texts), -np.inf, np.float32)
        rows, owner = [], []
        for i, words in enumerate(lists):
            ids = np.zeros(max(WINDOW, len(words)), np.int32)  # row 0: no word
            ids[:len(words)] = np.fromiter(map(look, words), np.int32, len(words))
            starts = window_starts(len(words))
            rows.append(ids[np.array(starts)[:, None] + np.arange(WINDOW)])
            owner.append(np.full(len(starts), i))
        windows, owner = np.concatenate(rows), np.concatenate(owner)
        for lo in range(0, len(windows), 2048):
            w = windows[lo:lo + 2048].T
            mask = (w > 0).astype(np.float32)
            score, _ = self.net.run({d: self.gates[d][w] for d in "fb"}, mask)
            np.maximum.at(best, owner[lo:lo + 2048], score)
        return 1 / (1 + np.exp(-np.clip(best.astype(float), -30, 30)))


def embed(table: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Word row plus the mean of the gram rows; ``flat`` holds the words' rows one after another."""
    starts = np.cumsum(sizes) - sizes
    x = table[flat]
    words = x[starts]
    grams = np.add.reduceat(x, starts) - words
    return words + grams / np.maximum(sizes - 1, 1)[:, None].astype(np.float32)


def fit_texts(texts: list[str | None], labels: np.ndarray, share: float | None = None) -> Model:
    """Train on texts with labels 0 or 1. ``share``: of toxic texts where scores are for, if not as here."""
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros((WORD_BUCKETS + GRAM_BUCKETS, EMBED), np.float32), None)
    rng = np.random.default_rng(SEED)
    vocabulary: dict[str, int] = {}
    lists = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(t)], np.int32) for t in texts]
    flat, sizes = word_features(["", *vocabulary])  # row 0: no word
    starts = np.cumsum(sizes) - sizes
    # document frequencies of every feature by label -> log odds
    seen = np.zeros((2, WORD_BUCKETS + GRAM_BUCKETS))
    for words, y in zip(lists, labels):
        ids = np.unique(words)
        if len(ids):
            seen[int(y), np.unique(flat[_spans(starts[ids], sizes[ids])])] += 1
    n = np.bincount(labels.astype(int), minlength=2)
    odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    odds *= (seen.sum(0) / (seen.sum(0) + 5))
    table = rng.normal(0, 0.05, (WORD_BUCKETS + GRAM_BUCKETS, EMBED)).astype(np.float32)
    table[:, 0] = np.clip(odds, -3, 5)
    net = Network(rng)
    del vocabulary
    windows = []
    for words in lists:
        ids = np.zeros(max(WINDOW, len(words)), np.int32)
        ids[:len(words)] = words
        s = np.array(window_starts(len(words)))
        if len(s) > TRAIN_WINDOWS:
            s = s[np.linspace(0, len(s) - 1, TRAIN_WINDOWS).astype(int)]
        windows.append(ids[s[:, None] + np.arange(WINDOW)])
    adam = {k: [np.zeros_like(x), np.zeros_like(x)] for k, x in net.p.items()}
    square = np.full(len(table), 1e-2, np.float32)  # Adagrad, a rate per row of the table
    step = 0
    per_epoch = -(-len(lists) // BATCH)
    for _ in range(max(EPOCHS, -(-MIN_STEPS // per_epoch))):
        order = rng.permutation(len(lists))
        for lo in range(0, len(order), BATCH):
            docs = order[lo:lo + BATCH]
            w = np.concatenate([windows[i] for i in docs])
            counts = np.array([len(windows[i]) for i in docs])
            words, back = np.unique(w, return_inverse=True)
            take = _spans(starts[words], sizes[words])
            x = embed(table, flat[take], sizes[words])
            x[words == 0] = 0
            x = x[back.reshape(w.shape)].transpose(1, 0, 2)
            mask = (w > 0).astype(np.float32).T
            score, _ = net.run(_gates(net, x), mask)
            first = np.cumsum(counts) - counts
            worst = np.array([a + int(np.argmax(score[a:a + c])) for a, c in zip(first, counts)])
            x, mask, at = x[:, worst], mask[:, worst], back.reshape(w.shape)[worst]
            gates = _gates(net, x)
            score, kept = net.run(gates, mask, keep=True)
            y = labels[docs].astype(np.float32)
            slope = ((_sig(score) - y) / len(docs)).astype(np.float32)
            g, dx = net.gradients(slope, gates, mask, kept, x)
            step += 1
            for k, grad in g.items():
                m, v = adam[k]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                net.p[k] -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
            _update(table, square, flat, starts, sizes, words, at, dx * mask[:, :, None], len(docs))
    if share is not None:
        net.p["bias"] = net.p["bias"] + np.float32(np.log(share / (1 - share)) - np.log(n[1] / n[0]))
    return Model(table, net)


def _gates(net: Network, x: np.ndarray) -> dict[str, np.ndarray]:
    return {d: x @ net.p[f"w{d}"] + net.p[f"c{d}"] for d in "fb"}


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])


def _update(table, square, flat, starts, sizes, words, at, dx, scale):
    """Adagrad step of the embedding rows that the windows' words use."""
    by_word = np.zeros((len(words), EMBED), np.float32)
    np.add.at(by_word, at.T.ravel(), dx.reshape(-1, EMBED))
    used = np.flatnonzero(np.abs(by_word).sum(1) > 0)
    if not len(used):
        return
    n = sizes[words[used]]
    rows = flat[_spans(starts[words[used]], n)]
    head = np.cumsum(n) - n
    share = np.repeat(1 / np.maximum(n - 1, 1), n).astype(np.float32)
    share[head] = 1
    grad = np.repeat(by_word[used], n, 0) * share[:, None] * scale
    unique, back = np.unique(rows, return_inverse=True)
    total = np.zeros((len(unique), EMBED), np.float32)
    np.add.at(total, back, grad)
    square[unique] += (total * total).mean(1)
    table[unique] -= 0.05 * total / np.sqrt(square[unique])[:, None]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) of the rows to learn from."""
    known = labels.filter("toxic in (0, 1)").select("doc_id", "toxic").dropDuplicates(["doc_id"])
    share = known.agg(F.avg("toxic")).first()[0]
    picked = bounded_sample(known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "toxic", SAMPLE_DOCS)
    wanted = docs.sparkSession.createDataFrame(picked.select(["doc_id", "toxic"]))  # of bounded size
    got = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").toArrow()
    order = np.argsort(got["doc_id"].to_numpy(), kind="stable")
    texts = got["text"].to_pylist()
    return fit_texts([texts[i] for i in order], got["toxic"].to_numpy()[order], share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, above 0.5: rather toxic) of every document."""
    shared = Shared(docs.sparkSession, model)

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for a in range(0, len(ids), 100):
                found = shared.value.scores(texts.slice(a, 100).to_pylist())
                yield pa.RecordBatch.from_arrays([ids.slice(a, 100), pa.array(found)], ["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
