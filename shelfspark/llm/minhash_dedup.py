"""Near-duplicate documents by one-permutation MinHash.

Method. A document's words give a set of hashed word shingles. One permutation
is split into ``BINS`` bins, each keeping its least hash; empty bins take the
value of a non-empty bin found by a fixed sequence of probes per bin (optimal
densification). Bands of ``ROWS`` bins are bucket keys. Documents with equal
sets are one node. In a bucket all nodes are linked to one centre, a star, so
a bucket of n nodes gives n - 1 candidate edges and not n(n-1)/2; every edge is
confirmed on the full sets.

A star can miss a pair that is similar to each other and not to the centre.
The exact way for those: nodes in buckets that still hold several components
after the first round get keys by prefix filtering. Their shingles are ordered
from rare to frequent, and two sets that are similar share one of their first
n - ceil(0.8 n) + 1 shingles, so pairs of different components that share such
a key, and whose lengths and key positions allow the similarity, are confirmed
as well. A key's nodes are compared in blocks of bounded size inside tasks; only
pairs that pass are emitted. Rare keys first means that a passage which many
documents share is no key.

Chance to miss: a pair of similarity 0.8 shares none of 20 bands of 4 rows with
probability (1 - 0.8^4)^20 = 2.7e-5, at 0.85 5e-7.

Defined cases: null, empty and white-space texts have the empty set and stay
alone. A node is a distinct set, named by the least id that has it, so repeated
rows are one node; when an id repeats with other texts, each row has the
component of its own text. A row with a null id is linked with nothing, its
component is null and it is kept. An empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import Shared, free_name, join_hot, likely, likely_in, stored
from shelfspark.llm.components import connected_components

BINS = 80
ROWS = 4
#: Edges of one centre that one task verifies; beyond it the centre's set is copied per salt.
EDGES_PER_SALT = 4000
#: Nodes of one prefix key that are compared at once.
BLOCK = 1024
#: Rows of blocks for a task; each is compared with up to two blocks.
BLOCK_ROWS_PER_TASK = 20_000
#: Counters of shingle frequencies; hashed, so their number is fixed.
FREQUENCY_BITS = 20

_M = np.uint64
_PRIME = [_M(0x9E3779B97F4A7C15), _M(0xC2B2AE3D27D4EB4F), _M(0x165667B19E3779F9)]


def _mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> _M(31))
    h = h * _M(0x7FB5D329728EA185)
    h = h ^ (h >> _M(27))
    h = h * _M(0x81DADEF4BC2DD44D)
    return h ^ (h >> _M(33))


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; words split on ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    w = np.fromiter(map(digest, words), np.uint64, len(words))
    n = min(width, len(w))
    h = w[:len(w) - n + 1] * _PRIME[0]
    for k in range(1, n):
        h = (h ^ w[k:len(w) - n + 1 + k]) * _PRIME[k % 3] + _M(k)
    if n < width:
        h = h ^ _M(n)
    return np.unique(_mix(h))


class Signer:
    """Band keys of a set: one permutation, ``bins`` bins, probes fixed by ``seed``."""

    def __init__(self, bins: int = BINS, rows: int = ROWS, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.bins, self.rows = bins, rows
        self.edges = np.array([-(-(b << 64) // bins) for b in range(bins)], np.uint64)
        self.probes = rng.integers(0, bins, (256, bins))
        self.seeds = rng.integers(1, 1 << 63, bins // rows).astype(np.uint64)

    def bin_values(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(hashes, self.edges)
        full = np.diff(at, append=len(hashes)) > 0
        values = hashes[np.minimum(at, len(hashes) - 1)]
        empty = np.flatnonzero(~full)
        source = np.arange(self.bins)
        for probe in self.probes:
            if not len(empty):
                break
            source[empty] = probe[empty]
            empty = empty[~full[source[empty]]]
        source[empty] = np.flatnonzero(full)[0]  # after 256 probes; any fixed rule does
        return values[source]

    def bands(self, hashes: np.ndarray) -> np.ndarray:
        v = self.bin_values(hashes).reshape(-1, self.rows)
        h = self.seeds.copy()
        for k in range(self.rows):
            h = _mix((h ^ v[:, k]) * _PRIME[k % 3])
        return h


def prefix_length(n: int, percent: int) -> int:
    """How many of n elements a set must show for every set that is ``percent`` similar to meet it."""
    return n - -(-percent * n // 100) + 1


_SIG_FIELDS = ["doc_id", "n", "h1", "h2", "keys"]
_SIG = "doc_id long, n long, h1 long, h2 long, keys array<long>"


def _signatures(width: int):
    def run(batches):
        signer = Signer()
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for a in range(0, len(ids), 500):
                n, h1, h2, keys = [], [], [], []
                for t in texts.slice(a, 500).to_pylist():
                    s = shingle_hashes(t, width)
                    n.append(len(s))
                    if not len(s):
                        h1.append(0), h2.append(0), keys.append(np.empty(0, np.int64))
                        continue
                    d = xxhash.xxh3_128_intdigest(s.tobytes())
                    h1.append((d >> 64) - (1 << 63)), h2.append((d & ((1 << 64) - 1)) - (1 << 63))
                    keys.append(signer.bands(s).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, 500), pa.array(n, pa.int64()), pa.array(h1, pa.int64()),
                     pa.array(h2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], _SIG_FIELDS)
    return run


def _sets(width: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text")
            for a in range(0, len(ids), 500):
                sets = [shingle_hashes(t, width).view(np.int64) for t in texts.slice(a, 500).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, 500), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])
    return run


def _linked(inter, n, m, percent: int):
    return 100 * inter >= percent * (n + m - inter)


def confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``edges`` (a, c, load) whose full sets are similar. ``load``: about how many edges c has."""
    salts = F.greatest(F.lit(1), F.ceil(F.col("load") / EDGES_PER_SALT)).cast("int")
    edges = edges.withColumn("salts", salts).withColumn(
        "salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int"))
    centres = edges.groupBy("c").agg(F.max("salts").alias("salts"))
    left = edges.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    right = (sets.select(F.col("id").alias("c"), F.col("shingles").alias("sc")).join(centres, "c")
             .select("c", "sc", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    inter = F.size(F.array_intersect("sa", "sc"))
    return (left.join(right, ["c", "salt"])
            .filter(_linked(inter, F.size("sa"), F.size("sc"), percent))
            .select(F.col("a").alias("u"), F.col("c").alias("v")))


def _prefixes(frequencies: np.ndarray, percent: int):
    mask = np.uint64(len(frequencies) - 1)

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                s = np.asarray(batch.column("shingles")[i].values).view(np.uint64)
                f = frequencies[(s & mask).astype(np.int64)]
                p = prefix_length(len(s), percent)
                first = np.lexsort((s, f))[:p]
                pos = np.flatnonzero(f[first] > 1)  # a shingle of one set is no key
                k = len(pos)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s[first[pos]].view(np.int64)),
                     *[pa.array(np.full(k, batch.column(c)[i].as_py(), np.int64)) for c in ("id", "component")],
                     pa.array(np.full(k, len(s), np.int64)), pa.array(pos.astype(np.int64))],
                    ["q", "id", "component", "n", "pos"])
    return run


def _block_pairs(percent: int):
    """Rows sorted by (q, x, y): emit the pairs of a block that may be similar."""
    fields = ["q", "x", "y", "b", "id", "component", "n", "pos"]

    def pairs(g: dict[str, np.ndarray]):
        x, y = g["x"][0], g["y"][0]
        i, j = np.flatnonzero(g["b"] == x), np.flatnonzero(g["b"] == y)
        for lo in range(0, len(i), 512):
            r = i[lo:lo + 512, None]
            n, m = g["n"][r], g["n"][j][None]
            need = -(-percent * (n + m) // (100 + percent))
            rest = np.minimum(n - g["pos"][r], m - g["pos"][j][None])
            ok = (g["component"][r] != g["component"][j][None]) & (rest >= need)
            ok &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            if x == y:
                ok &= g["id"][r] < g["id"][j][None]
            a, c = np.nonzero(ok)
            if len(a):
                u, v = g["id"][i[lo + a]], g["id"][j[c]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], ["a", "c"])

    def run(batches):
        kept = None
        for batch in batches:
            now = {f: batch.column(f).to_numpy() for f in fields}
            if kept is not None:
                now = {f: np.concatenate([kept[f], now[f]]) for f in fields}
            if not len(now["q"]):
                continue
            change = np.zeros(len(now["q"]), bool)
            for f in ("q", "x", "y"):
                change[1:] |= now[f][1:] != now[f][:-1]
            starts = np.concatenate([[0], np.flatnonzero(change)])
            for lo, hi in zip(starts[:-1], starts[1:]):
                yield from pairs({f: now[f][lo:hi] for f in fields})
            kept = {f: now[f][starts[-1]:] for f in fields}
        if kept is not None and len(kept["q"]):
            yield from pairs(kept)
    return run


def residual_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, c) of different components that may be similar, by prefix filtering over ``nodes``.

    ``nodes``: id, component, shingles. Complete: a similar pair is among the pairs.
    """
    spark = nodes.sparkSession
    size = 1 << FREQUENCY_BITS
    counts = (nodes.select(F.explode("shingles").alias("s"))
              .groupBy(F.col("s").bitwiseAND(size - 1).alias("at")).count().toArrow())
    frequencies = np.zeros(size, np.int32)
    frequencies[counts["at"].to_numpy()] = np.minimum(counts["count"].to_numpy(), 2 ** 31 - 1)
    shared = Shared(spark, frequencies)  # 4 MB whatever the corpus

    def prefixes(batches):
        yield from _prefixes(shared.value, percent)(batches)
    rows = stored(nodes.select("id", "component", "shingles").mapInArrow(
        prefixes, "q long, id long, component long, n long, pos long"), "prefixes")
    keys = (rows.groupBy("q").agg(F.count("*").alias("size"), F.min("component").alias("lo"),
                                  F.max("component").alias("hi"))
            .filter("lo != hi").select("q", "size"))
    blocks = F.ceil(F.col("size") / BLOCK)
    stored_keys = stored(keys, "prefix-keys")
    dealt = (join_hot(rows, stored_keys, ["q"], "size")
             .withColumn("blocks", blocks.cast("int"))
             .withColumn("b", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("q", F.least("b", "o").alias("x"), F.greatest("b", "o").alias("y"), "b",
                     "id", "component", "n", "pos"))
    # rows are few and comparisons many, so the number of tasks follows the rows and not their bytes
    n_rows = stored_keys.agg(F.sum(F.col("size") * F.ceil(F.col("size") / BLOCK))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(n_rows) // BLOCK_ROWS_PER_TASK))
    return (dealt.repartition(tasks, "q", "x", "y").sortWithinPartitions("q", "x", "y")
            .mapInArrow(_block_pairs(percent), "a long, c long").distinct())


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    base = docs.select(F.col("doc_id").cast("long"), "text")
    sig = stored(base.mapInArrow(_signatures(width), _SIG), "signatures")
    own = sig.filter("n > 0 and doc_id is not null")
    fp = ["n", "h1", "h2"]
    nodes = stored(own.groupBy(*fp).agg(F.min("doc_id").alias("id"), F.count("*").alias("rows"),
                                        F.first("keys").alias("keys")), "nodes")
    # buckets with more than one node; the least id is the centre
    rows = nodes.select(F.explode("keys").alias("key"), "id", "n")
    buckets = stored(rows.groupBy("key").agg(F.min(F.struct("id", "n")).alias("m"), F.count("*").alias("size"))
                     .filter("size > 1").select("key", F.col("m.id").alias("centre"),
                                                F.col("m.n").alias("centre_n"), "size"), "buckets")
    members = stored(join_hot(rows, buckets, ["key"], "size"), "members")
    # whole texts are not shuffled: a bitmap of the members' ids picks them where they lie
    texts = likely_in(base.select(F.col("doc_id").alias("id"), "text"), members.select("id").distinct(), "id")
    sets = stored(texts.mapInArrow(_sets(width), "id long, shingles array<long>"), "sets")
    star = (members.filter("id != centre")
            .filter(100 * F.least("n", "centre_n") >= percent * F.greatest("n", "centre_n"))
            .groupBy(F.col("id").alias("a"), F.col("centre").alias("c")).agg(F.max("size").alias("load")))
    links = stored(confirmed(star, sets, percent), "links")
    labels = connected_components(links)
    # the rest: nodes of buckets that still hold several components
    member_of = (members.select("key", "id", "size").join(labels, "id", "left")
                 .select("key", "id", "size", F.coalesce("component", "id").alias("component")))
    member_of = stored(member_of, "member-components")
    split = stored(member_of.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                                F.count("*").alias("size"))
                   .filter("lo != hi").select("key", "size"), "split-buckets")
    rest = (join_hot(member_of.drop("size"), split, ["key"], "size")
            .select("id", "component").distinct())
    rest = stored(rest.join(sets, "id"), "rest")
    more = residual_pairs(rest, percent).withColumn("load", F.lit(1).cast("long"))
    more = more.join(more.groupBy("c").agg(F.count("*").alias("degree")), "c").select(
        "a", "c", F.col("degree").alias("load"))
    extra = stored(confirmed(stored(more, "rest-pairs"), rest.select("id", "shingles"), percent), "rest-links")
    labels = connected_components(labels.select(F.col("id").alias("u"), F.col("component").alias("v"))
                                  .unionByName(extra))
    named = stored(nodes.select(*fp, "id", "rows").join(labels, "id", "left")
                   .filter("rows > 1 or component is not null")
                   .select(*fp, "rows", F.coalesce("component", "id").alias("component_id")), "named")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (join_hot(sig.select("doc_id", *fp), named, fp, "rows", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the one with the smallest id.

    Of rows that repeat id and text one stays; rows with a null id all stay.
    Whole texts are shuffled only where an id is to go or repeats.
    """
    found = stored(near_duplicates(docs, width, percent), "near-duplicates")
    gone = found.filter("not kept").select("doc_id").distinct()
    twice = found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    watched = stored(gone.unionByName(twice).distinct(), "watched-ids")
    flag, drop = free_name(docs, "flagged"), free_name(docs, "gone")
    rows = likely(docs, watched, "doc_id", flag)
    suspects = rows.filter(F.col(flag)).drop(flag)
    suspects = (suspects.join(gone.withColumn(drop, F.lit(True)), "doc_id", "left")
                .filter(F.col(drop).isNull()).select(*docs.columns))
    named = suspects.filter("doc_id is not null").dropDuplicates(["doc_id", "text"])
    return (rows.filter(~F.col(flag)).drop(flag).select(*docs.columns)
            .unionByName(named).unionByName(suspects.filter("doc_id is null")))
