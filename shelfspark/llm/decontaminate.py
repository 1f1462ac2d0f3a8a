"""Benchmark decontamination by latent semantic retrieval.

Texts are read in passages of 32 words that overlap by half. A passage is a
TF-IDF vector over the words of the benchmark (others cannot speak for a leak,
and words in more than ``MAX_SHARE`` of all passages are left out); word
frequencies come from all passages of the corpus. The vectors' leading right
singular space is found by a distributed randomised SVD: every task adds up its
share of A'(A G) for a random G (of the passages that do not overlap), the sums meet in Spark, and a Nystroem step on
the small result gives the singular vectors. Passages and the items' passages
are projected, and pairs with a cosine of at least ``MIN_COSINE`` there, and
of ``MIN_DIRECT`` before the projection, are candidates. Each is checked on the words of the text around the passage: the
longest common subsequence with the item, as a share of the item, must reach
``COPIED``, or ``PARAPHRASED`` where the item's answer (what follows its last
question mark, else its last sentence) is there too.

An item whose words a text holds all in a row is found whatever its length and
however frequent they are: at every place of the item's rarest word the sequences
are compared (``cosine`` is null where no passage around was a candidate). The
least of ``MIN_TERMS`` terms is asked of passages in the search for paraphrases only.

The texts are split into words once; their numbers (two bytes a word) are written
to the shared folder for the passes over all texts.

Bounds: items are taken in blocks of ``ITEMS_PER_BLOCK``, all texts against each
block; words are hashed to ``FEATURES`` places at most, so what the driver and a
task hold for the SVD is FEATURES * RANK numbers.

The space is that of a block's words, so which paraphrases of an item are found
depends on the other items of its block; exact copies do not.

Defined cases: null, empty and white-space texts and items match nothing;
repeated rows are judged one by one; an item that repeats is found under each
of its ids; words that all passages share stay in for items which have too few
others; empty tables give no rows and remove nothing; extra columns are passed
on or ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import Shared, stored

PASSAGE = 32
STRIDE = 16
MAX_SHARE = 0.01
#: Terms that a passage needs; items with fewer lend their most frequent words too.
MIN_TERMS = 4
RANK = 192
PASSES = 1
FEATURES = 1 << 14
MIN_COSINE = 0.35
#: Least cosine before the projection; of unrelated passages nearly all are below.
MIN_DIRECT = 0.2
COPIED = 0.7
PARAPHRASED = 0.45
ANSWERED = 0.8
ITEMS_PER_BLOCK = 5000
TEXTS_AT_ONCE = 100
SEED = 6

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(None, _PUNCTUATION).split()


def answer_of(text: str) -> list[bytes]:
    """Words after the last question mark, else of the last sentence (the last third if there is one only)."""
    if "?" in text and words_of(text.rpartition("?")[2]):
        return words_of(text.rpartition("?")[2])
    sentences = [w for w in map(words_of, re.split(r"(?<=[.!?])\s+", text)) if w]
    if len(sentences) > 1:
        return sentences[-1]
    words = words_of(text)
    return words[-max(1, len(words) // 3):]


def common_subsequence(masks: dict[int, int], n: int, words: list[int], least: float = 0) -> int:
    """Length of the longest common subsequence; ``masks``: word -> bits of its places among n.

    If it is sure to be below ``least``, 0 may be returned instead.
    """
    known = [masks[w] for w in words if w in masks]
    if len(known) < least:
        return 0
    full = (1 << n) - 1
    row = full
    for places in known:
        hit = row & places
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


class Benchmark:
    """The items of a block: their words by number, and what the checks need."""

    def __init__(self, items: list[tuple[int, str]]):
        self.index: dict[bytes, int] = {}
        self.items = []
        for item_id, text in items:
            words = [self.index.setdefault(w, len(self.index)) for w in words_of(text)]
            if words:
                answer = [self.index.setdefault(w, len(self.index)) for w in answer_of(text)]
                self.items.append((item_id, words, masks_of(words), masks_of(answer), len(answer)))
        self.n = len(self.index)
        self.sequences = [np.array(words, np.int64).tobytes() for _, words, *_ in self.items]
        #: Of stored term numbers.
        self.kind = "<u2" if self.n < 1 << 16 else "<u4"

    def terms(self, text: str | None) -> np.ndarray:
        """Number of each word of a text, ``n`` for a word that no item has."""
        get, none = self.index.get, self.n
        words = words_of(text)
        return np.fromiter((get(w, none) for w in words), np.int64, len(words))

    def item_starts(self, words: list[int]) -> list[int]:
        return [0] if len(words) <= PASSAGE else [*range(0, len(words) - PASSAGE, STRIDE), len(words) - PASSAGE]


class Space:
    """Weights of the terms, and after the SVD their latent vectors."""

    def __init__(self, bench: Benchmark, passages: int, counts: np.ndarray):
        self.bench = bench
        share = counts / max(1, passages)
        active = share <= MAX_SHARE
        for _, words, *_ in bench.items:
            for s in bench.item_starts(words):
                own = sorted(set(words[s:s + PASSAGE]), key=lambda t: (share[t], t))
                active[own[:MIN_TERMS]] = True
        idf = np.log((1 + passages) / (1 + counts))
        self.weight = np.append(np.where(active, np.maximum(idf, 1e-3), 0), 0).astype(np.float32)
        n = max(1, bench.n)
        self.feature = np.append(np.arange(n) if n <= FEATURES else np.arange(n) % FEATURES, 0)[:bench.n + 1]
        self.size = min(n, FEATURES)
        self.latent: np.ndarray | None = None
        # each item's rarest word, for the search of whole word sequences
        self.anchored: dict[int, list[tuple[int, int]]] = {}
        for k, (_, words, *_) in enumerate(bench.items):
            at = min(range(len(words)), key=lambda i: (counts[words[i]], i))
            self.anchored.setdefault(words[at], []).append((k, at))
        self.is_anchor = np.zeros(bench.n + 1, bool)
        self.is_anchor[list(self.anchored)] = True

    def rows(self, texts: list[np.ndarray], grid: bool = True, overlap: bool = True):
        """Passages as sparse unit vectors: starts into (feature, weight), and (text, first word) of each."""
        if grid:
            counts = np.array([max(1, -(-len(t) // STRIDE) - 1) for t in texts])
        else:
            counts = np.ones(len(texts), np.int64)
        base = np.cumsum(counts) - counts
        length = np.array([len(t) for t in texts])
        flat = np.concatenate(texts) if texts else np.empty(0, np.int64)
        at = np.flatnonzero(self.weight[flat])
        text = np.searchsorted(np.cumsum(length), at, side="right")
        term = flat[at]
        if grid:
            g = (at - (np.cumsum(length) - length)[text]) // STRIDE
            second, first = g < counts[text], g > 0
            if not overlap:  # the passages with an even number
                second, first = second & (g % 2 == 0), first & (g % 2 == 1)
            window = np.concatenate([(base[text] + g)[second], (base[text] + g - 1)[first]])
            term = np.concatenate([term[second], term[first]])
        else:
            window = text
        key, tf = np.unique(window * np.int64(self.bench.n + 1) + term, return_counts=True)
        window, term = key // (self.bench.n + 1), key % (self.bench.n + 1)
        weight = (1 + np.log(tf)).astype(np.float32) * self.weight[term]
        terms = np.bincount(window, minlength=int(counts.sum()))
        keep = terms >= (MIN_TERMS if grid else 1)
        use = keep[window]
        window, term, weight = window[use], term[use], weight[use]
        norm = np.sqrt(np.bincount(window, weight * weight, minlength=len(keep)))
        weight /= norm[window].astype(np.float32)
        kept = np.flatnonzero(keep)
        starts = np.searchsorted(window, kept)
        owner = np.searchsorted(np.cumsum(counts), kept, side="right")
        return starts, self.feature[term], weight, owner, (kept - base[owner]) * STRIDE

    def project(self, starts, feature, weight, matrix) -> np.ndarray:
        if not len(starts):
            return np.zeros((0, matrix.shape[1]), np.float32)
        return np.add.reduceat(weight[:, None] * matrix[feature], starts)


def _read(batches, bench: Benchmark) -> Iterator[list[np.ndarray]]:
    """Blocks of the term numbers of texts, as ``numbered`` has them."""
    for batch in batches:
        terms = batch.column("terms")
        for a in range(0, len(terms), TEXTS_AT_ONCE):
            yield [np.frombuffer(t, bench.kind).astype(np.int64) for t in terms.slice(a, TEXTS_AT_ONCE).to_pylist()]


def numbered(docs: DataFrame, shared) -> DataFrame:
    """(doc_id, terms): the term numbers of every text, written once for the passes over all texts."""
    def run(batches):
        bench = shared.value
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for a in range(0, len(texts), TEXTS_AT_ONCE):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, TEXTS_AT_ONCE),
                     pa.array([bench.terms(t).astype(bench.kind).tobytes() for t in texts.slice(a, TEXTS_AT_ONCE).to_pylist()],
                              pa.binary())], ["doc_id", "terms"])
    return stored(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, terms binary"), "numbered")


def frequencies(terms: DataFrame, shared) -> tuple[int, np.ndarray]:
    """Number of passages (that do not overlap) of the corpus, and of those that hold each term."""
    def run(batches):
        bench = shared.value
        counts, passages = np.zeros(bench.n + 1, np.int64), 0
        for texts in _read(batches, bench):
            for t in texts:
                passages += -(-len(t) // PASSAGE)
                at = np.flatnonzero(t < bench.n)
                key = np.unique((at // PASSAGE) * np.int64(bench.n) + t[at])
                counts += np.bincount(key % max(1, bench.n), minlength=bench.n + 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(counts[at], passages))], ["term", "n"])
    bench = shared.value
    got = terms.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = got["term"].to_numpy(), got["n"].to_numpy()
    counts = np.zeros(bench.n, np.int64)
    counts[term[term >= 0]] = n[term >= 0]
    return int(n[term < 0].sum()), counts


_BLOCK = 32


def _gram_times(terms: DataFrame, shared, matrix: np.ndarray) -> np.ndarray:
    """A'(A matrix), each task adding up its share."""
    factor = Shared(terms.sparkSession, matrix.astype(np.float32))

    def run(batches):
        space, g = shared.value, factor.value
        total = np.zeros((space.size, g.shape[1]))
        for texts in _read(batches, space.bench):
            starts, feature, weight, _, _ = space.rows(texts, overlap=False)
            if not len(starts):
                continue
            z = space.project(starts, feature, weight, g)
            row = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(feature)))
            order = np.argsort(feature, kind="stable")
            f = feature[order]
            first = np.flatnonzero(np.diff(f, prepend=-1))
            total[f[first]] += np.add.reduceat(weight[order, None] * z[row[order]], first)
        for b in range(0, space.size, _BLOCK):
            part = total[b:b + _BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([part.tobytes()])],
                                                 ["block", "sums"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, data in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist()):
                part = np.frombuffer(data)
                sums[b] = sums[b] + part if b in sums else part
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()])], ["block", "sums"])
    kind = "block int, sums binary"
    got = terms.select("terms").mapInArrow(run, kind).repartition("block").mapInArrow(add, kind).toArrow()
    y = np.zeros((shared.value.size, matrix.shape[1]))
    for b, data in zip(got["block"].to_pylist(), got["sums"].to_pylist()):
        y[b:b + _BLOCK] = np.frombuffer(data).reshape(-1, matrix.shape[1])
    return y


def singular_vectors(terms: DataFrame, shared, rank: int = RANK, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors [features, rank] of all passages, and the singular values.

    Each pass over the texts multiplies by A'A once; further passes sharpen the leading vectors.
    """
    size = shared.value.size
    g = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, min(rank, size))))[0]
    for left in range(passes - 1, -1, -1):
        y = _gram_times(terms, shared, g)
        if left:
            g = np.linalg.qr(y)[0]
    # Nystroem: C ~ Y (G'Y)^-1 Y' for C = A'A, with a small shift for stability
    shift = 1e-9 * max(1e-30, np.abs(y).max())
    y += shift * g
    inner = g.T @ y
    w, e = np.linalg.eigh((inner + inner.T) / 2)
    half = (y @ e) / np.sqrt(np.maximum(w, shift))
    u, s, _ = np.linalg.svd(half, full_matrices=False)
    return u, s


def sequences_in(space: Space, texts: list[np.ndarray]) -> dict[tuple[int, int], int]:
    """(text, item) -> first word, where a text holds all words of an item in a row."""
    found: dict[tuple[int, int], int] = {}
    for text, terms in enumerate(texts):
        data = None
        for at in np.flatnonzero(space.is_anchor[terms]).tolist():
            for item, before in space.anchored[int(terms[at])]:
                first = at - before
                words = space.bench.sequences[item]
                if first < 0 or first + len(words) // 8 > len(terms) or (text, item) in found:
                    continue
                data = terms.tobytes() if data is None else data
                if data.startswith(words, 8 * first):
                    found[text, item] = first
    return found


def leaks_in(space: Space, items: np.ndarray, owners: np.ndarray, direct: list[dict[int, float]],
             texts: list[np.ndarray]) -> list[tuple]:
    """(text, item, first word, cosine, share, answered) of the best place of each leak."""
    best: dict[tuple[int, int], tuple] = {k: (first, None, 1.0, True) for k, first in sequences_in(space, texts).items()}
    starts, feature, weight, owner, first = space.rows(texts)
    if not len(starts) or not len(items):
        return [(t, i, *x) for (t, i), x in best.items()]
    z = space.project(starts, feature, weight, space.latent)
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    ends = np.append(starts[1:], len(feature))
    for lo in range(0, len(z), 4096):
        cosine = z[lo:lo + 4096] @ items.T
        for p, q in zip(*np.nonzero(cosine >= MIN_COSINE)):
            c, p = float(cosine[p, q]), p + lo
            own = slice(starts[p], ends[p])
            has = direct[q]
            if sum(w * has.get(f, 0.0) for f, w in zip(feature[own].tolist(), weight[own].tolist())) < MIN_DIRECT:
                continue
            text, item = int(owner[p]), int(owners[q])
            found = best.get((text, item))
            if found and found[2] >= 1:
                if found[1] is None:
                    best[text, item] = (found[0], c, *found[2:])
                continue
            _, words, masks, answer, n_answer = space.bench.items[item]
            begin = max(0, int(first[p]) - len(words))
            region = texts[text][begin:int(first[p]) + PASSAGE + len(words)].tolist()
            share = common_subsequence(masks, len(words), region, PARAPHRASED * len(words)) / len(words)
            if share < PARAPHRASED:
                continue
            answered = common_subsequence(answer, n_answer, region) >= ANSWERED * n_answer
            if (share >= COPIED or answered) and (not found or share > found[2]):
                best[text, item] = (int(first[p]), c, share, answered)
    return [(t, i, *x) for (t, i), x in best.items()]


def _spaces(docs: DataFrame, benchmark: DataFrame) -> Iterator:
    """For each block of items: a broadcast (space, item vectors, their items), and the texts' term numbers."""
    spark = docs.sparkSession
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("long"), "text")
    blocks = -(-items.count() // ITEMS_PER_BLOCK)
    for b in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text")
        rows = block.toArrow()
        bench = Benchmark(list(zip(rows["item_id"].to_pylist(), rows["text"].to_pylist())))
        if not bench.items:
            continue
        shared = Shared(spark, bench)
        terms = numbered(docs.select(F.lit(None).cast("long").alias("doc_id") if "doc_id" not in docs.columns
                                     else F.col("doc_id").cast("long").alias("doc_id"), "text"), shared)
        space = Space(bench, *frequencies(terms, shared))
        space.latent = singular_vectors(terms, Shared(spark, space))[0].astype(np.float32)
        parts = [(k, np.array(words[s:s + PASSAGE])) for k, (_, words, *_) in enumerate(bench.items)
                 for s in bench.item_starts(words)]
        starts, feature, weight, owner, _ = space.rows([w for _, w in parts], grid=False)
        q = space.project(starts, feature, weight, space.latent)
        q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)
        direct = [dict(zip(feature[a:b].tolist(), weight[a:b].tolist()))
                  for a, b in zip(starts, np.append(starts[1:], len(feature)))]
        yield Shared(spark, (space, q, np.array([k for k, _ in parts])[owner], direct)), terms


LEAK = "doc_id long, item_id long, start long, cosine double, share double, answered boolean"


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The items (item_id, text) that each text (doc_id, text) holds: a row per pair."""
    def search(shared):
        def run(batches):
            space, q, owners, direct = shared.value
            for batch in batches:
                ids = batch.column("doc_id")
                for a, part in zip(range(0, len(ids), TEXTS_AT_ONCE), _read([batch], space.bench)):
                    found = leaks_in(space, q, owners, direct, part)
                    if found:
                        t, i, start, cosine, share, answered = zip(*found)
                        yield pa.RecordBatch.from_arrays(
                            [ids.slice(a, TEXTS_AT_ONCE).take(pa.array(t)),
                             pa.array([space.bench.items[k][0] for k in i], pa.int64()),
                             pa.array(start, pa.int64()), pa.array(cosine, pa.float64()), pa.array(share, pa.float64()),
                             pa.array(answered)],
                            [x.split()[0] for x in LEAK.split(", ")])
        return run
    out = docs.sparkSession.createDataFrame([], LEAK)
    for shared, terms in _spaces(docs, benchmark):
        out = out.unionByName(terms.mapInArrow(search(shared), LEAK))
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the texts that hold an item; rows are judged where they lie, so ids may be null."""
    fields = docs.columns

    def search(shared):
        def run(batches):
            space, q, owners, direct = shared.value
            for batch in batches:
                texts = batch.column(fields.index("text"))
                clean = np.ones(len(texts), bool)
                for a in range(0, len(texts), TEXTS_AT_ONCE):
                    part = [space.bench.terms(t) for t in texts.slice(a, TEXTS_AT_ONCE).to_pylist()]
                    clean[[a + t for t, *_ in leaks_in(space, q, owners, direct, part)]] = False
                yield batch.filter(pa.array(clean))
        return run
    for shared, _ in _spaces(docs, benchmark):
        docs = docs.mapInArrow(search(shared), docs.schema)
    return docs
