import numpy as np
from pyspark.sql import functions as F

from shelfspark.llm import nn_descent as nn

SCHEMA = "vec_id long, embedding array<double>, node string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x")
                                  for i, v in rows], SCHEMA).repartition(4)


def exact(rows, asks, k):
    """query -> [(id, score)]: all products, in double precision."""
    good = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if asks(i):
            near = sorted(((float(v @ w), j) for j, w in good if j != i), key=lambda x: (-x[0], x[1]))
            out[i] = [(j, s) for s, j in near[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8) * rng.uniform(0.1, 3)) for i in range(60)]
    got, want = found(nn.nearest(table(spark, rows), F.col("id") % 5 == 0, 7)), exact(
        [(i, list(v)) for i, v in rows], lambda i: i % 5 == 0, 7)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_defined_cases(spark):
    rows = ([(0, [1, 0]), (20, None), (40, []), (60, [0, 0]), (80, [1, None]), (100, [1, float("nan")]),
             (120, [float("inf"), 1]), (140, [1, 2, 3]), (None, [1, 1])]
            + [(i, [2, 0]) for i in range(1, 6)] + [(6, [0, 1]), (160, [-1, -1])])
    got = found(nn.nearest(table(spark, rows), F.col("id") % 20 == 0, 4))
    assert got.keys() == {0, 160}
    assert got[0] == [(1, 2.0), (2, 2.0), (3, 2.0), (4, 2.0)]  # copies in order of their ids
    assert got[160] == [(0, -1.0), (6, -1.0), (1, -2.0), (2, -2.0)]
    assert nn.nearest(table(spark, rows).limit(0), F.col("id") % 20 == 0).count() == 0
    assert nn.nearest(table(spark, [(0, [1, 1])]), F.col("id") % 20 == 0).count() == 0


def test_hot_copies_do_not_hide_the_rest(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2, 3, 4]) for i in range(400)] + [(i, list(rng.normal(size=4))) for i in range(400, 700)]
    got = found(nn.nearest(table(spark, rows), F.col("id") % 100 == 0, 10, block=64))
    want = exact(rows, lambda i: i % 100 == 0, 10)
    assert got[100][:2] == [(0, 30.0), (1, 30.0)] and len(got[100]) == 10
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want]
    assert np.mean(hits) > 0.95


def test_repeated_ids_with_other_vectors(spark):
    rows = [(0, [1, 0]), (0, [0, 1]), (1, [3, 1]), (2, [1, 5])]
    got = nn.nearest(table(spark, rows), F.col("id") == 0, 1).collect()
    assert sorted((r.query_id, r.vec_id, r.score) for r in got) == [(0, 1, 3.0), (0, 2, 5.0)]


def test_descent_finds_what_blocks_do_not(spark):
    """Recall against brute force where the first graph is poor, with vectors of many lengths."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 16)) * rng.uniform(0.5, 2, size=(3000, 1))
    rows = [(i, list(v)) for i, v in enumerate(x)]
    vectors = nn.usable(table(spark, rows))
    nodes, _, dim = nn.nodes_of(vectors)
    unit = {r.node: np.frombuffer(r.unit, np.float16).astype(np.float32) for r in nodes.collect()}
    ids = np.array(list(unit))
    m = np.stack(list(unit.values()))
    s = m @ m.T
    np.fill_diagonal(s, -9)
    near = {int(ids[k]): set(ids[np.argsort(-s[k])[:20]].tolist()) for k in range(len(ids))}

    def recall(edges):
        got = {}
        for r in edges.collect():
            got.setdefault(r.node, []).append((-r.sim, r.nbr))
        return np.mean([len({b for _, b in sorted(got.get(a, []))[:20]} & n) / 20 for a, n in near.items()])
    first = recall(nn.first_edges(nodes, dim, 2, 10, 64))
    built = recall(nn.build_graph(nodes, dim, trees=2, block=64))
    assert first < 0.5 and built > 0.95
    asked = exact(rows, lambda i: i % 20 == 0, 20)
    got = found(nn.nearest(table(spark, rows), F.col("id") % 20 == 0, 20, trees=2, block=64))
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / 20 for q, w in asked.items()]) >= 0.95


def test_groups_are_not_cut():
    import pyarrow as pa
    keys = np.repeat(np.arange(50), np.random.default_rng(3).integers(1, 40, 50))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[a:a + 17])], ["k"]) for a in range(0, len(keys), 17)]
    got = list(nn._whole_groups(batches, "k", 60))
    assert np.array_equal(np.concatenate([b.column("k").to_numpy() for b in got]), keys)
    seen = [set(b.column("k").to_pylist()) for b in got]
    assert len(got) > 3 and all(not a & b for k, a in enumerate(seen) for b in seen[k + 1:])


def test_query_has_the_contract_columns(spark):
    from shelfspark.llm.catalog import op11_nn_descent
    got = op11_nn_descent(spark, "/root/testdata/sf0.001")
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    want = exact(rows, lambda i: i % 20 == 0, 20)
    have = found(got)
    assert have.keys() == want.keys()
    assert np.mean([len({i for i, _ in have[q]} & {i for i, _ in w}) / 20 for q, w in want.items()]) >= 0.95
    for q, w in have.items():
        assert len(w) == 20 and [s for _, s in w] == sorted((s for _, s in w), reverse=True)
