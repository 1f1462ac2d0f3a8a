"""Approximate nearest neighbours by inner product: an NN-descent graph and greedy search in it.

Equal vectors are one node of the graph, so any number of copies neither crowds
the lists nor cuts the graph apart; the copies of a node come back when results
are written.

Largest inner product is made nearest direction: vectors are divided by the
largest length found and get one more component that fills them up to length 1 (0 in a
query), so the graph is right for vectors of any lengths. Graph and search work on
these in half precision; results are scored on the original vectors in doubles.

Build: a first graph comes from blocks of rows that are beside each other in
the order of random hyperplane signs. Then NN-descent: a node's neighbours and
the nodes that have it as neighbour (``sample`` of each kind and age a round,
by a hash) meet in one group, where every pair with a member not compared
before is compared; a pair is reported to either side whose list it enters.
Rounds are joins and windows over flat edge tables, written to the shared
folder, and end when fewer than ``settled`` of the list entries change.

Search: a beam of ``beam`` nodes per query starts from its own node's list and
from the nearest of a bounded set of entry nodes. In every round all nodes of
the beam not yet visited are joined with their neighbours in both directions,
unseen ones are scored, the best stay; it ends when the beams hold no new node.

Defined cases: a null id, a vector that is null, empty, zero, or has a null or
non-finite component, or not the table's most frequent number of components
(the larger of equally frequent ones) takes no part. Rows with a query's own id
are its own and no candidates, also if that id repeats. Ties go to the smaller
id. Repeated rows are candidates each. Fewer candidates than asked give fewer
rows, an empty table none. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import Shared, stored

NEIGHBOURS = 40
SAMPLE = 16
BLOCK = 512
TREES = 10
ROUNDS = 12
SETTLED = 0.05
BEAM = 112
ENTRIES = 512
SEED = 11

EDGE = "node long, nbr long, sim float"


def usable(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, vec array<double>) of the rows that take part."""
    v = F.col("vec")
    good = rows.select(F.col(id_column).cast("long").alias("id"),
                       F.col(vector_column).cast("array<double>").alias("vec")).filter(
        F.col("id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(v, lambda x: x != 0))
    sizes = good.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return good.filter(F.size("vec") == (sizes[0][0] if sizes else 0))


def _doubles(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _without_fill(unit):
    """``unit`` of a query: its last component is 0, so that products order as those of the vectors themselves."""
    size = F.length(unit)
    return F.concat(F.substring(unit, F.lit(1), size - 2), F.unhex(F.lit("0000")))


def _halves(column: pa.Array, dim: int) -> np.ndarray:
    """Half-precision vectors of a binary column, as float32 rows."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(-1, dim).astype(np.float32)


def _whole_groups(batches, key: str, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Batches of some ``rows`` rows in which no value of ``key`` is cut (the input is sorted by it)."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        all_of = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        keys = all_of.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield all_of.slice(0, cut)
        held, n = [all_of.slice(cut)], all_of.num_rows - cut
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def nodes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Distinct vectors as (node, vec, unit); the members (id, node) of each; components of ``unit``."""
    distinct = stored(vectors.groupBy("vec").agg(F.count("*").alias("n"))
                      .withColumn("node", F.monotonically_increasing_id()), "ann-distinct")
    # of the hot vectors all rows but the first copy find their node by a broadcast of bounded size
    hot = stored(distinct.orderBy(F.desc("n"), "node").limit(1000), "ann-hot").select("vec", "node")
    members = (vectors.join(F.broadcast(hot), "vec").unionByName(
        vectors.join(F.broadcast(hot), "vec", "left_anti").join(distinct.select("vec", "node"), "vec"))
        .select("id", "node"))
    top = distinct.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)), F.max(F.size("vec"))).first()
    if top[1] is None:
        return distinct.select("node", "vec", F.lit(b"").alias("unit")), members, 0
    longest, dim = float(np.sqrt(top[0])), int(top[1])

    def encode(batches):
        for batch in batches:
            x = _doubles(batch.column("vec"), dim) / longest
            fill = np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))
            unit = np.column_stack([x, fill]).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("vec"), pa.array([r.tobytes() for r in unit], pa.binary())],
                ["node", "vec", "unit"])
    return (stored(distinct.select("node", "vec").mapInArrow(encode, "node long, vec array<double>, unit binary"),
                   "ann-nodes"), members, dim + 1)


def _block_edges(dim: int, keep: int, block: int) -> Callable:
    def compare(tree, node, unit):
        x = _halves(unit, dim)
        for a in range(0, len(node), block):
            some = slice(a, min(a + block, len(node)))
            sims = x[some] @ x[some].T
            np.fill_diagonal(sims, -2)
            k = min(keep, len(sims) - 1)
            if k < 1:
                continue
            best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(node[some], k)), pa.array(node[some][best].ravel()),
                 pa.array(np.take_along_axis(sims, best, 1).ravel())], ["node", "nbr", "sim"])

    def run(batches):
        for batch in _whole_groups(batches, "tree"):
            trees = batch.column("tree").to_numpy()
            for t in np.unique(trees):
                a, b = np.searchsorted(trees, [t, t + 1])
                part = batch.slice(a, b - a)
                yield from compare(t, part.column("node").to_numpy(), part.column("unit"))
    return run


def first_edges(nodes: DataFrame, dim: int, trees: int, keep: int, block: int) -> DataFrame:
    """Each node's nearest among the rows beside it, in ``trees`` orders by the signs of random hyperplanes."""
    planes = np.random.default_rng(SEED).normal(size=(trees, dim, 30)).astype(np.float32)

    def sign(batches):
        bits = 1 << np.arange(29, -1, -1, dtype=np.int64)
        for batch in batches:
            x = _halves(batch.column("unit"), dim)
            for t in range(trees):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array((x @ planes[t] > 0) @ bits),
                     batch.column("node"), batch.column("unit")], ["tree", "sign", "node", "unit"])
    signed = nodes.select("node", "unit").mapInArrow(sign, "tree int, sign long, node long, unit binary")
    order = ["tree", "sign", F.xxhash64("node", "tree"), "node"]
    return (signed.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("tree", "node", "unit").mapInArrow(_block_edges(dim, keep, block), EDGE))


def _compare_groups(dim: int, keep: int, together: int = 128) -> Callable:
    """Rows (at, member, fresh, unit, least) sorted by ``at`` -> edges that enter the list of their node."""
    def groups(batch):
        at, member = batch.column("at").to_numpy(), batch.column("member").to_numpy()
        fresh = batch.column("fresh").to_numpy(zero_copy_only=False).astype(bool)
        order = np.lexsort((~fresh, member, at))  # of a member that is there twice the fresh one stays
        at, member, fresh = at[order], member[order], fresh[order]
        first = np.append(True, (at[1:] != at[:-1]) | (member[1:] != member[:-1]))
        rows = order[first]
        return at[first], member[first], fresh[first], rows

    def run(batches):
        for batch in _whole_groups(batches, "at"):
            at, member, fresh, rows = groups(batch)
            x = _halves(batch.column("unit"), dim)
            least = batch.column("least").to_numpy()[rows]
            x = x[rows]
            start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            size = np.diff(np.append(start, len(at)))
            out = []
            for g in np.array_split(np.argsort(size, kind="stable"), max(1, len(size) // together)):
                width = int(size[g].max())
                place = start[g][:, None] + np.arange(width)
                there = np.arange(width) < size[g][:, None]
                place = np.where(there, place, start[g][:, None])
                v = x[place]
                sims = v @ v.transpose(0, 2, 1)
                new = fresh[place] & there
                pair = ((new[:, :, None] & there[:, None, :]) | (there[:, :, None] & new[:, None, :]))
                pair &= sims > least[place][:, :, None]
                pair[:, np.arange(width), np.arange(width)] = False
                k, i, j = np.nonzero(pair)
                out.append((member[place[k, i]], member[place[k, j]], sims[k, i, j]))
            node, nbr, sim = (np.concatenate(c) for c in zip(*out))
            # each pair once, of a node the best ``keep``
            order = np.lexsort((nbr, -sim, node))
            node, nbr, sim = node[order], nbr[order], sim[order]
            once = np.append(True, (node[1:] != node[:-1]) | (nbr[1:] != nbr[:-1]))[:len(node)]
            node, nbr, sim = node[once], nbr[once], sim[once]
            head = np.flatnonzero(np.append(True, node[1:] != node[:-1])[:len(node)])
            rank = np.arange(len(node)) - np.repeat(head, np.diff(np.append(head, len(node))))
            best = rank < keep
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[best]), pa.array(nbr[best]), pa.array(sim[best])], ["node", "nbr", "sim"])
    return run


def _best_lists(edges: DataFrame, keep: int, born: int) -> DataFrame:
    """The ``keep`` nearest of each node; ``pick`` orders its entries of one age by a hash."""
    node = Window.partitionBy("node")
    once = edges.repartition("node").groupBy("node", "nbr").agg(
        F.max("sim").alias("sim"), F.min("fresh").alias("fresh"), F.min("born").alias("born"))
    return (once.withColumn("rank", F.row_number().over(node.orderBy(F.desc("sim"), "nbr"))).filter(F.col("rank") <= keep)
            .withColumn("pick", F.row_number().over(
                Window.partitionBy("node", "fresh").orderBy(F.xxhash64("node", "nbr", F.lit(born)), "nbr"))))


def build_graph(nodes: DataFrame, dim: int, neighbours: int = NEIGHBOURS, sample: int = SAMPLE, trees: int = TREES,
                block: int = BLOCK, rounds: int = ROUNDS, settled: float = SETTLED) -> DataFrame:
    """Edges (node, nbr, sim): the nearest of each node that NN-descent has found."""
    n = nodes.count()
    first = first_edges(nodes, dim, trees, max(1, neighbours // 4), block).select(
        "*", F.lit(True).alias("fresh"), F.lit(0).alias("born"))
    graph = stored(_best_lists(first, neighbours, 0), "ann-graph")
    for number in range(1, rounds + 1):
        taken = graph.filter(F.col("pick") <= sample)
        reverse = taken.select(F.col("nbr").alias("at"), F.col("node").alias("member"), "fresh").withColumn(
            "pick", F.row_number().over(Window.partitionBy("at", "fresh").orderBy(
                F.xxhash64("at", "member", F.lit(-number)), "member"))).filter(F.col("pick") <= sample).drop("pick")
        groups = (taken.select(F.col("node").alias("at"), F.col("nbr").alias("member"), "fresh")
                  .unionByName(reverse)
                  .unionByName(nodes.select(F.col("node").alias("at"), F.col("node").alias("member"),
                                            F.lit(True).alias("fresh"))))
        last = graph.groupBy("node").agg(
            F.when(F.count("*") < neighbours, F.lit(-2.0)).otherwise(F.min("sim")).cast("float").alias("least"))
        known = nodes.select("node", "unit").join(last, "node", "left").select(
            F.col("node").alias("member"), "unit", F.coalesce("least", F.lit(-2.0).cast("float")).alias("least"))
        found = (groups.join(known, "member").select("at", "member", "fresh", "unit", "least")
                 .repartition("at").sortWithinPartitions("at")
                 .mapInArrow(_compare_groups(dim, neighbours), EDGE))
        graph = stored(_best_lists(
            graph.select("node", "nbr", "sim", (F.col("fresh") & (F.col("pick") > sample)).alias("fresh"), "born")
            .unionByName(found.select("*", F.lit(True).alias("fresh"), F.lit(number).alias("born"))),
            neighbours, number), "ann-graph")
        if graph.filter(F.col("born") == number).count() <= settled * neighbours * n:
            break
    return graph.select("node", "nbr", "sim")


def _score(dim: int) -> Callable:
    """(q, node, unit, asked) -> (q, node, sim)."""
    def run(batches):
        for batch in batches:
            sims = np.einsum("ij,ij->i", _halves(batch.column("unit"), dim), _halves(batch.column("asked"), dim))
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("node"), pa.array(sims)], ["q", "node", "sim"])
    return run


def _from_entries(entries, dim: int, take: int) -> Callable:
    def run(batches):
        node, x = entries.value
        for batch in batches:
            sims = _halves(batch.column("asked"), dim) @ x.T
            best = np.argsort(-sims, axis=1, kind="stable")[:, :take]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("q").to_numpy(), best.shape[1])), pa.array(node[best].ravel()),
                 pa.array(np.take_along_axis(sims, best, 1).ravel())], ["q", "node", "sim"])
    return run


def search(nodes: DataFrame, graph: DataFrame, asked: DataFrame, dim: int, beam: int = BEAM,
           entries: int = ENTRIES) -> DataFrame:
    """Greedy search for ``asked`` (q, asked, own node or null): the beam (q, node) of each query at its end."""
    spark = nodes.sparkSession
    some = nodes.orderBy(F.xxhash64("node", F.lit(SEED)), "node").limit(entries).select("node", "unit").toArrow()
    shared = Shared(spark, (some["node"].to_numpy(), _halves(some["unit"].combine_chunks(), dim)))
    neighbours = graph.groupBy("node").count().agg(F.max("count")).first()[0] or 1
    back = graph.withColumn("rank", F.row_number().over(Window.partitionBy("nbr").orderBy(F.desc("sim"), "node"))).filter(
        F.col("rank") <= neighbours).select(F.col("nbr").alias("node"), F.col("node").alias("nbr"))
    near = stored(graph.select("node", "nbr").unionByName(back).groupBy("node").agg(F.collect_set("nbr").alias("nbrs")),
                  "ann-near")
    units = nodes.select("node", "unit")

    def best(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("sim"), "node"))
        return found.withColumn("rank", rank).filter(F.col("rank") <= beam).drop("rank")

    def scored(pairs: DataFrame) -> DataFrame:
        return (pairs.join(units, "node").join(asked.select("q", "asked"), "q")
                .select("q", "node", "unit", "asked").mapInArrow(_score(dim), "q long, node long, sim float"))
    start = (asked.select("q", "asked").mapInArrow(_from_entries(shared, dim, 8), "q long, node long, sim float")
             .unionByName(scored(asked.filter("own is not null").select("q", F.col("own").alias("node")))))
    state = stored(best(start.groupBy("q", "node").agg(F.max("sim").alias("sim")))
                   .withColumn("open", F.lit(True)), "ann-beam")
    seen = state.groupBy("q").agg(F.collect_list("node").alias("seen"))
    while True:
        opened = state.filter("open")
        if opened.isEmpty():
            return state.select("q", "node")
        # a query that is at its end opens no node and so drops out of the step
        step = stored(
            opened.select("q", "node").join(near, "node").groupBy("q").agg(F.collect_list("nbrs").alias("nbrs"))
            .join(seen, "q").select("q", "seen", F.array_except(F.array_distinct(F.flatten("nbrs")), "seen").alias("new")),
            "ann-step")
        seen = step.select("q", F.concat("seen", "new").alias("seen"))
        new = scored(step.select("q", F.explode("new").alias("node")))
        state = stored(best(state.withColumn("open", F.lit(False))
                            .unionByName(new.withColumn("open", F.lit(True)))), "ann-beam")


def nearest(rows: DataFrame, asks, neighbours: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
            beam: int = BEAM, **graph_settings) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of each row for whose id ``asks`` (a column of ``id``) holds."""
    vectors = stored(usable(rows, id_column, vector_column), "ann-vectors")
    nodes, members, dim = nodes_of(vectors)
    members = stored(members, "ann-members")
    queries = stored(members.filter(asks).distinct().join(nodes, "node").select(
        F.monotonically_increasing_id().alias("q"), "id", F.col("node").alias("own"),
        F.col("vec").alias("asked_vec"), _without_fill(F.col("unit")).alias("asked")), "ann-queries")
    if not dim:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    graph = build_graph(nodes, dim, **graph_settings)
    found = search(nodes, graph, queries.select("q", "asked", "own"), dim, max(beam, neighbours + 1))

    def exact(batches):
        for batch in batches:
            a, b = (_doubles(batch.column(c), dim - 1) for c in ("vec", "asked_vec"))
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("id"), batch.column("node"),
                                              pa.array(np.einsum("ij,ij->i", a, b))], ["q", "id", "node", "score"])
    scored = (found.join(nodes.select("node", "vec"), "node").join(queries.select("q", "id", "asked_vec"), "q")
              .select("q", "id", "node", "vec", "asked_vec")
              .mapInArrow(exact, "q long, id long, node long, score double"))
    # of a node, more copies than asked for and the query's own row are never needed
    few = members.withColumn("copy", F.row_number().over(Window.partitionBy("node").orderBy("id"))).filter(
        F.col("copy") <= neighbours + 1).select("node", F.col("id").alias("vec_id"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return (scored.join(few, "node").filter("vec_id != id").withColumn("rank", rank).filter(F.col("rank") <= neighbours)
            .select(F.col("id").alias("query_id"), "rank", "vec_id", "score"))
