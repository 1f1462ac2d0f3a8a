import random

import pytest

from shelfspark.llm import minhash_dedup as m
from shelfspark.llm.components import connected_components


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]


def brute(rows, width, percent):
    """doc id -> (size, component): all pairs of distinct sets."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = (frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    shared = words(rng, 40)  # a passage that many documents hold
    out = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one two three")]
    for g in range(12):
        base = words(rng, rng.choice([12, 60, 200]))
        for k in range(rng.choice([2, 5, 12])):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 20)):
                w[rng.randrange(len(w))] = words(rng, 1)[0]
            out.append((100 * g + 10 + k, " ".join(w)))
    for k in range(40):
        out.append((5000 + k, " ".join(words(rng, 25) + shared + words(rng, 25))))
    out.append((9000, " ".join(words(rng, 30_000))))
    out.append((9001, "same " * 5000))
    return out


def test_equals_all_pairs(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n int, key string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in m.near_duplicates(df, 4, 80).collect()}
    want = brute(rows, 4, 80)
    assert got == want
    kept = {r.doc_id for r in m.deduplicated(df, 4, 80).collect()}
    assert kept == {i for i, (_, c) in want.items() if i == c}


def test_residual_pairs_miss_none(spark, rows):
    texts = [(i, t) for i, t in rows if t and t.split()]
    nodes = spark.createDataFrame([(i, i, m.shingle_hashes(t, 4).view("int64").tolist()) for i, t in texts],
                                  "id long, component long, shingles array<long>")
    pairs = {tuple(sorted(r)) for r in m.residual_pairs(nodes, 80).collect()}
    want = brute(texts, 4, 80)
    for a, _ in texts:
        for b, _ in texts:
            if a < b and want[a][1] == want[b][1]:
                x, y = (set(m.shingle_hashes(dict(texts)[i], 4).tolist()) for i in (a, b))
                if 100 * len(x & y) >= 80 * len(x | y) and x != y:
                    assert (a, b) in pairs


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (8, "a b c d e f")],
                               "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in m.near_duplicates(df).collect()), key=str)
    assert got == sorted([(7, 7, True), (7, 7, True), (8, 7, False), (None, None, True)], key=str)
    assert sorted(str(r.doc_id) for r in m.deduplicated(df).collect()) == ["7", "None"]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert m.near_duplicates(none).collect() == [] and m.deduplicated(none).collect() == []


def test_components_of_chains_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (150, 100), (300, 300)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(1, 61)}, 150: 100, 200: 100}


def test_bands_find_similar_sets():
    import numpy as np
    rng, signer, missed = np.random.default_rng(2), m.Signer(), 0
    for _ in range(500):
        x = rng.integers(0, 2 ** 64, 100, dtype=np.uint64)
        a, b = np.unique(x[:90]), np.unique(x[10:])  # similarity 0.8
        missed += not set(signer.bands(a).tolist()) & set(signer.bands(b).tolist())
    assert missed <= 2
