"""Ranked lexical search over bags of words, each distinct bag scored once.

A term is a run of ASCII letters and digits and of any characters beyond ASCII,
A-Z lower-cased. A document is reduced to its bag: the terms that occur in some
item, with their frequencies, and its length factor m. Documents with the same
bag and the same m score alike for every item, so they form a class: rows are
grouped by a hash of the bag, and the bag and m themselves beside it, which
tells apart bags of equal hashes. A task scores the classes it holds against all
items and keeps the best of each item; of the classes that win, the members with
the least ids are fetched by the broadcast hashes (and the bags compared again)
and listed by ascending id.

Scores are integers: with N documents that have a term, L terms in all, n terms
in the document, m = 100 - 75 + (75 n N) div L; a term in df documents weighs
w = floor(1000 ln((2N + 2) / (2 df + 1))) and adds, for every time it stands in
the item, w * ((10^9 tf) div (1000 tf + 8 m)).

N, L and df come from all documents. Items are taken in blocks of
``terms_per_block`` terms at most (a longer item is a block of its own), all
documents against each block; what a task holds of the items is bounded so, and
results do not depend on the blocks.

Defined cases: a null text or item and one without terms match nothing, and such
a document does not count for N; rows with the same id are documents of their
own, listed one by one; items with the same id are ranked one by one; of equal
scores the least doc_id comes first, null after all; empty tables give no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import Shared, stored

TOP = 10
TERMS_PER_BLOCK = 200_000
TEXTS_AT_ONCE = 200

#: ASCII bytes that are part of no term become blanks, A-Z become a-z, bytes of other characters stay.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

RESULT = "item_id long, rank int, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


class Items:
    """A block of items: numbers of their terms, and for each term the items that hold it how often."""

    def __init__(self, items: list[tuple[int, list[bytes]]]):
        self.ids = [i for i, _ in items]
        self.number: dict[bytes, int] = {}
        where: list[list[tuple[int, int]]] = []
        for place, (_, terms) in enumerate(items):
            for term, times in Counter(terms).items():
                k = self.number.setdefault(term, len(self.number))
                if k == len(where):
                    where.append([])
                where[k].append((place, times))
        self.start = np.cumsum([0] + [len(w) for w in where])
        self.item = np.array([i for w in where for i, _ in w], np.int64)
        self.times = np.array([t for w in where for _, t in w], np.int64)

    def bag(self, terms: list[bytes]) -> bytes:
        """Numbers of the known terms in order, each with its frequency, as 32-bit integers."""
        get = self.number.get
        found = np.fromiter((k for k in map(get, terms) if k is not None), np.int32)
        known, times = np.unique(found, return_counts=True)
        return np.column_stack([known, times]).astype("<i4").tobytes()


def item_blocks(items: DataFrame, terms_per_block: int) -> Iterator[Items]:
    """All items with terms, in blocks; the stated query set passes the driver block by block."""
    held, n = [], 0
    for row in items.select(F.col("item_id").cast("long"), "text").filter("text is not null").orderBy(
            "item_id", "text").toLocalIterator():
        terms = terms_of(row[1])
        if held and n + len(terms) > terms_per_block:
            yield Items(held)
            held, n = [], 0
        if terms:
            held.append((row[0], terms))
            n += len(terms)
    if held:
        yield Items(held)


def bags(docs: DataFrame, shared) -> DataFrame:
    """(doc_id, n_terms, bag) of every document."""
    def run(batches):
        items = shared.value
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for a in range(0, len(texts), TEXTS_AT_ONCE):
                terms = [terms_of(t) for t in texts.slice(a, TEXTS_AT_ONCE).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, TEXTS_AT_ONCE), pa.array(list(map(len, terms)), pa.int64()),
                     pa.array([items.bag(t) for t in terms], pa.binary())], ["doc_id", "n_terms", "bag"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_terms long, bag binary")


def document_counts(bagged: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each term of the block is; tasks add up their share."""
    def run(batches):
        counts = np.zeros(terms, np.int64)
        for batch in batches:
            data = np.frombuffer(b"".join(batch.column("bag").to_pylist()), "<i4")
            counts += np.bincount(data[::2], minlength=terms)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["term", "n"])
    got = bagged.select("bag").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(terms, np.int64)
    out[got["term"].to_numpy()] = got["n"].to_numpy()
    return out


def _score(shared, weight: np.ndarray, top: int, pairs_at_once: int = 2_000_000) -> Callable:
    """Classes (hash, m, bag, first) -> per item the ``top`` of them that this task holds."""
    def scored(items, m, data):
        # postings of all classes in a row, then each posting for every item of its term
        size = np.array([len(b) // 8 for b in data])
        flat = np.frombuffer(b"".join(data), "<i4").reshape(-1, 2).astype(np.int64)
        owner = np.repeat(np.arange(len(data)), size)
        term, tf = flat[:, 0], flat[:, 1]
        adds = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[owner]))
        width = items.start[term + 1] - items.start[term]
        upto = np.cumsum(width)
        for a, b in _cuts(upto, owner, pairs_at_once):
            n = int(width[a:b].sum())
            at = np.arange(n) - np.repeat(np.cumsum(width[a:b]) - width[a:b], width[a:b]) + np.repeat(
                items.start[term[a:b]], width[a:b])
            key = np.repeat(owner[a:b], width[a:b]) * len(items.ids) + items.item[at]
            value = np.repeat(adds[a:b], width[a:b]) * items.times[at]
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
            head = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
            total = np.add.reduceat(value, head) if len(head) else value
            keep = total > 0
            yield key[head][keep] // len(items.ids), key[head][keep] % len(items.ids), total[keep]

    def run(batches):
        items = shared.value
        best = None  # item, score, first, hash, m, bag of the best so far
        for batch in batches:
            m, data = batch.column("m").to_numpy(), batch.column("bag").to_pylist()
            first = batch.column("first")
            late = first.is_null().to_numpy(zero_copy_only=False)
            first_n = first.fill_null(0).to_numpy()
            hashes = batch.column("hash").to_numpy()
            for row, item, total in scored(items, m, data):
                found = (item, total, late[row], first_n[row], hashes[row], m[row],
                         np.array([data[r] for r in row], object))
                best = found if best is None else tuple(np.concatenate(x) for x in zip(best, found))
                order = np.lexsort((best[4], best[3], best[2], -best[1], best[0]))
                ranked = best[0][order]
                head = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[:len(ranked)])
                rank = np.arange(len(ranked)) - np.repeat(head, np.diff(np.append(head, len(ranked))))
                best = tuple(x[order[rank < top]] for x in best)
        if best is not None:
            item, total, late, first_n, hashes, m, data = best
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), pa.array(total), pa.array(first_n, mask=late), pa.array(hashes), pa.array(m),
                 pa.array(list(data), pa.binary())], ["item", "score", "first", "hash", "m", "bag"])
    return run


def _cuts(upto: np.ndarray, owner: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of postings with some ``most`` pairs, none of which parts a class."""
    a = 0
    while a < len(upto):
        base = upto[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(upto, base + most, side="right")))
        if b < len(upto):
            b = int(np.searchsorted(owner, owner[b - 1], side="right")) if owner[b - 1] == owner[a] else int(
                np.searchsorted(owner, owner[b - 1]))
        yield a, b
        a = b


def classes_of(bagged: DataFrame, n: int, total: int) -> DataFrame:
    """``bagged`` with m and the hash of the class; documents without a term of the items are left out."""
    m = (25 + F.expr(f"(75 * n_terms * {n}L) div {max(1, total)}L")).cast("long")
    return bagged.filter(F.length("bag") > 0).withColumn("m", m).withColumn("hash", F.xxhash64("bag", "m"))


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP,
                   terms_per_block: int = TERMS_PER_BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], RESULT)
    for block in item_blocks(items, terms_per_block):
        shared = Shared(spark, block)
        bagged = stored(bags(docs, shared), "bags")
        n, total = bagged.filter("n_terms > 0").agg(F.count("*"), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        if not n:
            return out
        df = document_counts(bagged, len(block.number)).tolist()
        weight = np.array([floor(1000 * log((2 * n + 2) / (2 * d + 1))) for d in df], np.int64)
        member = classes_of(bagged, n, total)
        key = ["hash", "m", "bag"]
        classes = member.groupBy(*key).agg(F.min("doc_id").alias("first"))
        kind = "item long, score long, first long, hash long, m long, bag binary"
        order = [F.desc("score"), F.asc_nulls_last("first"), "hash", "m", "bag"]
        winners = stored(
            classes.select("first", *key).mapInArrow(_score(shared, weight, top), kind)
            .withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .filter(F.col("place") <= top), "lexical-winners")
        # at most ``top`` hashes an item of the block; of a class the ``top`` least ids are enough
        hashes = F.broadcast(winners.select("hash").distinct())
        few = (member.join(hashes, "hash", "left_semi")
               .withColumn("copy", F.row_number().over(Window.partitionBy(*key).orderBy(F.asc_nulls_last("doc_id"))))
               .filter(F.col("copy") <= top).select("doc_id", *key))
        names = spark.createDataFrame([(k, i) for k, i in enumerate(block.ids)], "item long, item_id long")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        out = out.unionByName(
            winners.select("item", "score", *key).join(few, key).withColumn("rank", rank).filter(F.col("rank") <= top)
            .join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
