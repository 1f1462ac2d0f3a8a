import random

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import decontaminate as d


def words(rng, n, size=400):
    return [f"w{int(size * rng.random() ** 2)}" for _ in range(n)]


def brute(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 20))] for _ in range(2))
        assert d.common_subsequence(d.masks_of(a), len(a), b) == brute(a, b)


def test_answers():
    assert d.answer_of("What is it? A blue bird.") == [b"a", b"blue", b"bird"]
    assert d.answer_of("First one. Second two.") == [b"second", b"two"]
    assert d.answer_of("one two three four five six") == [b"five", b"six"]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(7)
    items = [(i, " ".join(words(rng, rng.choice([16, 30, 58]), 3000)) + ". the answer is " + f"key{i} ring{i}.")
             for i in range(30)] + [(90, None), (91, ""), (92, "?!")]
    rows, leaks = [], set()
    for i in range(240):
        w = words(rng, rng.choice([5, 60, 700]), 3000)
        if i % 4 == 0:
            k = i // 4 % 30
            item = items[k][1].split()
            if i % 8 == 0:  # a paraphrase: some words replaced, not the answer
                for j in range(0, len(item) - 5, 5):
                    item[j] = f"swap{j}"
            at = rng.randrange(len(w))
            w[at:at] = [x.upper() + "!!" for x in item] if i % 3 == 0 else item
            leaks.add((i, k))
        rows.append((i, " ".join(w), "x", 1))
    rows += [(900, None, "x", 1), (901, "", "x", 1), (None, items[3][1], "x", 1), (902, items[3][1], "x", 1),
             (902, items[3][1], "x", 1), (903, "w1 " * 60_000, "x", 1)]
    leaks |= {(902, 3), (None, 3)}
    return (spark.createDataFrame(rows, "doc_id long, text string, item_id string, share int").repartition(4),
            spark.createDataFrame(items, "item_id long, text string"), leaks)


def test_planted_items_and_paraphrases(spark, tables):
    docs, items, want = tables
    got = {(r.doc_id, r.item_id) for r in d.leaks(docs, items).collect()}
    assert got == want  # recall and precision
    clean = d.decontaminated(docs, items)
    assert clean.columns == docs.columns
    ids = [r.doc_id for r in clean.select("doc_id").collect()]
    assert sorted(ids) == sorted({*range(240), 900, 901, 903} - {i for i, _ in want})


def test_candidates_against_the_whole_space(spark, tables):
    """Of the leaks that LCS alone confirms over all texts and items, the search finds at least 0.9."""
    docs, items, _ = tables
    bench = d.Benchmark([(r.item_id, r.text) for r in items.collect() if r.text])
    found = {(r.doc_id, r.item_id) for r in d.leaks(docs, items).collect()}
    true = set()
    for r in docs.collect():
        terms = bench.terms(r.text).tolist()
        for item_id, w, masks, answer, n in bench.items:
            for at in range(0, len(terms), 16):
                region = terms[at:at + 2 * len(w)]
                if d.common_subsequence(masks, len(w), region) >= d.COPIED * len(w):
                    true.add((r.doc_id, item_id))
                    break
    assert len(true & found) >= 0.9 * len(true)


def test_singular_vectors(spark, tables):
    """The randomised space holds nearly what the exact one does."""
    import numpy as np
    from shelfspark.llm.common import Shared
    docs, items, _ = tables
    bench = d.Benchmark([(r.item_id, r.text) for r in items.collect() if r.text])
    terms = d.numbered(docs, Shared(spark, bench))
    space = d.Space(bench, *d.frequencies(terms, Shared(spark, bench)))
    u, s = d.singular_vectors(terms, Shared(spark, space), rank=60, passes=3)
    starts, feature, weight, _, _ = space.rows([bench.terms(r.text) for r in docs.collect()], overlap=False)
    a = np.zeros((len(starts), space.size))
    a[np.repeat(np.arange(len(starts)), np.diff(starts, append=len(feature))), feature] = weight
    exact = np.linalg.svd(a, compute_uv=False)
    assert abs(u.T @ u - np.eye(u.shape[1])).max() < 1e-6
    assert abs(s[:10] - exact[:10]).max() < 0.1 * exact[0] and np.linalg.norm(a @ u[:, 0]) > 0.9 * exact[0]


def test_empty_tables(spark, tables):
    docs, items, _ = tables
    assert d.leaks(docs.limit(0), items).collect() == []
    assert d.leaks(docs, items.limit(0)).collect() == []
    assert d.decontaminated(docs, items.filter(F.lit(False))).count() == docs.count()


def test_short_and_frequent_items_are_found_word_by_word(spark):
    """Items of one and two words, one of frequent words only, and one that lies over passage borders."""
    rng = random.Random(11)
    common = [f"often{k}" for k in range(6)]
    rare = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    def text(n, *inside):
        out = [rng.choice(common) if rng.random() < 0.6 else rare(1)[0] for _ in range(n)]
        for k, words in enumerate(inside):
            out[10 * k + 7:10 * k + 7] = words
        return " ".join(out)
    frequent = ["often3", "often3", "often1", "often5", "often5", "often2", "often0", "often4"]
    long = [*frequent, "often1", *frequent[::-1], "often0", "often1", "often0", "often0", "often2", "often2", "often2"]
    items = [(1, "Zyx quux!"), (2, " ".join(frequent)), (3, "single"), (4, " ".join(long)), (5, None), (6, "?!")]
    docs = [(1, text(200, ["zyx", "QUUX"])), (2, text(200, ["quux", "zyx"])), (3, text(400, frequent)),
            (4, text(90, rare(3), ["Single,"])), (5, "zyx - quux"), (6, text(300, long)), (7, "zyx"), (8, None), (9, ""),
            *[(k, text(150)) for k in range(20, 60)]]

    def in_a_row(t, i):
        t, i = d.words_of(t), d.words_of(i)
        return any(t[k:k + len(i)] == i for k in range(len(t) - len(i) + 1)) if i else False
    want = {(a, b) for a, t in docs for b, i in items if in_a_row(t, i)}
    got = d.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                  spark.createDataFrame(items, "item_id long, text string")).collect()
    have = {(r.doc_id, r.item_id) for r in got if r.share == 1.0}
    assert {(1, 1), (5, 1), (3, 2), (4, 3), (6, 4), (6, 2)} <= want and want <= have
    clean = d.decontaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                             spark.createDataFrame(items, "item_id long, text string"))
    assert not {r.doc_id for r in clean.collect()} & {a for a, _ in want}
