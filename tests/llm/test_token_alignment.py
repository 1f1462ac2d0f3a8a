import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfspark.llm import token_alignment as ta


def tokens(coders, text):
    """(id, from, to) of both sides, one by one."""
    if not text:
        return [], []
    data = (" " + text).encode()
    a = coders.a.encode(" " + text, add_special_tokens=False).ids
    b = coders.b.encode(text)
    sides = []
    for ids, table in ((a, coders.a_bytes), (b, coders.b_bytes)):
        at, out = 0, []
        for i in ids:
            out.append((i, at, at + len(table[i])))
            at += len(table[i])
        if b"".join(table[i] for i in ids) != data:
            return [], []
        sides.append(out)
    return sides


def brute(coders, rows):
    docs = [(d, *tokens(coders, t)) for d, t in rows]
    links = [[(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for _, a, b in docs]
    count = Counter(p for l in links for p in set(l))
    high = defaultdict(int)
    for (a, _), n in count.items():
        high[a] = max(high[a], n)
    out = []
    for (d, a, b), l in zip(docs, links):
        both = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, low = [], 0
        for cut in both:
            groups.append("|".join(",".join(str(x[0]) for x in side if low <= x[1] < cut) for side in (a, b)))
            low = cut
        text = ";".join(groups)
        out.append((d, len(a), len(b), len(groups), len(l), sum(count[p] == high[p[0]] for p in l),
                    sum(count[p] for p in l), sha256(text.encode()).hexdigest() if text else ""))
    return out


@pytest.fixture(scope="module")
def coders():
    return ta.Tokenizers(None, None)


def corpus():
    rng = random.Random(5)
    words = "straße naïve unbelievable tokenization don't 12345 🙂🙃 日本語 <|endoftext|> <s> </s> \t\t \n\n   -- x^2 Ωmega ﬁne".split(" ")
    rows = [(1, None), (2, ""), (3, " "), (4, "▁ piece mark"), (5, "a▁b"), (6, "plain words here"),
            (6, "plain words here"), (None, "plain words here"), (7, "é combining \x00 null"), (8, "x" * 3000),
            (9, "<0x41> bytes"), (10, "\r\n end \r"), (11, "<unk>"), (12, "﻿mark �")]
    return rows + [(100 + k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for k in range(60)]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("known", [1 << 20, 40, 0])
def test_equals_one_by_one(spark, coders, known):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, pairs string").repartition(3)
    got = ta.link_counts(docs, known_pairs=known)
    assert got.columns == COLUMNS
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(coders, rows), key=key)


def test_texts_not_given_back_have_no_tokens(spark):
    docs = spark.createDataFrame([(1, "a▁b"), (2, None), (3, "")], "doc_id long, text string")
    assert {tuple(r) for r in ta.link_counts(docs).collect()} == {(d, 0, 0, 0, 0, 0, 0, "") for d in (1, 2, 3)}
    assert ta.link_counts(docs.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.randoms(use_true_random=False))
def test_coalescing(sizes, rng):
    """Groups and links of any two tilings of the same bytes against the definition."""
    total = sum(sizes)
    other, left = [], total
    while left:
        other.append(min(left, rng.randint(1, 6)))
        left -= other[-1]
    a, b = np.cumsum(sizes), np.cumsum(other)
    a_group, b_group, link_a, link_b = ta.coalesce(np.array(sizes), np.array(other))
    cuts = sorted(set(a) & set(b))
    assert a_group.tolist() == [sum(c < e for c in cuts) for e in a]
    assert b_group.tolist() == [sum(c < e for c in cuts) for e in b]
    over = {(i, j) for i in range(len(a)) for j in range(len(b))
            if a[i] - sizes[i] < b[j] and b[j] - other[j] < a[i]}
    assert len(link_a) == len(over) and set(zip(link_a.tolist(), link_b.tolist())) == over


def test_no_tokens():
    got = ta.coalesce(np.array([], int), np.array([], int))
    assert all(len(x) == 0 for x in got)


def test_query_has_the_contract_columns(spark, coders):
    from shelfspark.llm.catalog import op12_token_alignment
    got = op12_token_alignment(spark, "/root/testdata/sf0.001")
    assert got.dtypes == [(c, "string" if c == "groups_sha256" else "bigint") for c in COLUMNS]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    some = {r.doc_id: tuple(r) for r in got.collect()}
    assert len(some) == len(rows)
    for d, a, b in ((d, *tokens(coders, t)) for d, t in rows[:20]):
        assert some[d][1:3] == (len(a), len(b)) and some[d][4] == len(a) + len(b) - some[d][3]
