import pyarrow as pa
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import packing

LONG = " ".join(f"word{i} x{i % 7}" for i in range(1500))
TEXTS = [(1, "Hello, world it's 9 o'clock"), (2, None), (3, ""), (4, LONG), (4, LONG), (5, "a\x1cb <|endoftext|> c"),
         (6, "Ünïcode  spaces\u0085and İstanbul ΣΑΣ é"), (None, "no id"), (7, "tie tie"), (8, "tie tie")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", 9) for i, t in TEXTS],
                                 "doc_id long, text string, bin string, length int")


def expected(text):
    ids = packing.load_tokenizer(None).encode(text or "", add_special_tokens=False).ids + [0]
    return [(p, a, len(ids[a:a + 2048]), zlib.crc32(np.asarray(ids[a:a + 2048], "<u4").tobytes()))
            for p, a in enumerate(range(0, len(ids), 2048))]


def test_pieces_are_the_tokenizers_ids(docs):
    got = sorted(tuple(r) for r in packing.pieces(docs).collect() if r.doc_id is not None)
    want = sorted((i, *x) for i, t in TEXTS if i is not None for x in expected(t))
    assert got == want


@pytest.mark.parametrize("per_task,open_bins", [(200_000, 8192), (3, 2)])
def test_sequences_are_full_and_gapless(spark, docs, per_task, open_bins):
    many = docs.unionByName(spark.range(10, 120).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("token soup "), (F.col("id") * 13 % 900).cast("int")).alias("text"),
        F.lit("x").alias("bin"), F.lit(9).alias("length")))
    rows = packing.pack_documents(many, open_bins=open_bins, items_per_task=per_task).collect()
    assert len(rows) == packing.pieces(many).count()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    if per_task > 3:
        least = -(-sum(r.length for r in rows) // 2048)
        assert len(by) <= least + 2


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(none).collect() == []


def test_best_fit_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert [bins.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # the third open one closes bin 2
    assert bins.still_open() == {0: 6, 1: 7}
    assert bins.place(3) == (1, 7)  # tightest: 3 free
    assert bins.place(2) == (0, 6)
    assert bins.still_open() == {0: 8}


def test_words_are_encoded_as_in_context():
    import random
    rng = random.Random(5)
    alphabet = "aAbBzZ'sStTéÉñß019,.!-_|#İıŒσςǅ²½Ⅳ\u0301\u00a0\u2003\u200b한글中文א 🙂\t\n"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(800)]
    coder = packing.WordEncoder(None, cached=300)
    tokenizer = packing.load_tokenizer(None)
    for a in range(0, len(texts), 50):
        for t, got in zip(texts[a:a + 50], coder.block(pa.array(texts[a:a + 50], pa.string()))):
            assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
