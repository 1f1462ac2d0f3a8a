import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from shelfspark.llm import lexical as lx

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top):
    bags = [(d, terms(t)) for d, t in docs]
    held = [(d, t) for d, t in bags if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = Counter(x for _, t in held for x in set(t))
    out = []
    for item, text in items:
        found = []
        for d, t in held:
            m = 25 + (75 * len(t) * n_docs) // n_terms
            tf = Counter(t)
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10 ** 9 * tf[x] // (1000 * tf[x] + 8 * m))
                        for x in terms(text) if x in tf)
            if score > 0:
                found.append((score, d))
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, k + 1, d, s) for k, (s, d) in enumerate(found[:top])]
    return out


DOCS = [
    (1, "The quick brown FOX, the quick-brown fox!"), (2, "the fox"), (3, "fox the"), (4, None), (5, ""), (6, " .,\t"),
    (7, "Ünïcode ÄÖ quick fox"), (8, "ünïcode äö"), (9, "quick " * 3000), (9, "quick brown"), (None, "the fox"),
    (10, "the\x00fox\x7fthe"), (11, "number 42 4 2"), (12, "k" * 50_000 + " fox"),
] + [(k, "the fox") for k in range(100, 140)] + [(k, "fox, the!") for k in range(140, 150)]
ITEMS = [(1, "quick fox fox"), (2, "THE"), (3, None), (4, "?!"), (5, "äö ÄÖ 42"), (5, "brown"), (6, "nowhere"),
         (7, "the the the fox brown quick number")]


def rows(spark, docs, items):
    return (spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, hash string").repartition(5),
            spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize("top,per_block", [(10, 200_000), (3, 4), (60, 1)])
def test_equals_brute_force_in_any_blocks(spark, top, per_block):
    docs, items = rows(spark, DOCS, ITEMS)
    got = [tuple(r) for r in lx.rank_documents(docs, items, top, per_block).collect()]
    by = lambda r: (r[0], r[1], -r[3], r[2] is None, r[2] or 0)
    assert sorted(got, key=by) == sorted(brute(DOCS, ITEMS, top), key=by)


def test_classes_hold_equal_bags_only(spark):
    docs, items = rows(spark, DOCS, ITEMS)
    block = next(lx.item_blocks(items, 10 ** 6))
    from shelfspark.llm.common import Shared
    bagged = lx.bags(docs, Shared(spark, block))
    member = lx.classes_of(bagged, 58, 3500)
    sizes = sorted(r["count"] for r in member.groupBy("hash", "m", "bag").count().collect())
    assert sizes[-1] == 53  # "the fox" in any order and marks, with the null id, is one class
    assert member.select("hash").distinct().count() == len(sizes)


def test_empty_tables(spark):
    docs, items = rows(spark, DOCS, ITEMS)
    assert lx.rank_documents(docs.limit(0), items).count() == 0
    assert lx.rank_documents(docs, items.limit(0)).count() == 0
    assert lx.rank_documents(docs.filter("text is null"), items).count() == 0


def test_cuts_keep_classes_whole():
    owner = np.repeat([0, 1, 2, 3], [3, 1, 4, 2])
    upto = np.cumsum([5, 5, 5, 1, 9, 9, 9, 9, 1, 1])
    cuts = list(lx._cuts(upto, owner, 12))
    assert cuts[0][0] == 0 and cuts[-1][1] == 10
    assert all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert all(b == 10 or owner[b - 1] != owner[b] for _, b in cuts)


def test_query_has_the_contract_columns(spark):
    from shelfspark.llm.catalog import op13_lexical_search
    got = op13_lexical_search(spark, "/root/testdata/sf0.001")
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert got.filter("rank = 1").count() == spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").count()
