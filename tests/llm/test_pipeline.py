"""The pipeline and the queries on the small tables."""
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline as c
    from shelfspark.llm.common import stored
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in c.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        out.append((name, docs))
    return out


def test_stages_in_order(stages):
    assert [n for n, _ in stages] == ["documents", "quality_classifier", "near_dedup", "decontamination", "pii",
                                      "best_fit_packing"]
    for _, df in stages[1:-1]:
        assert df.dtypes == stages[0][1].dtypes
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for _, df in stages]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[3] == ids[4] == ids[5] and len(ids[3]) < len(ids[0])


def test_near_dedup_against_all_pairs(stages):
    from test_dedup import brute
    before = [(r.doc_id, r.text) for r in stages[1][1].collect()]
    want = {i for i, (_, c) in brute(before, 5, 80).items() if i == c}
    assert {r.doc_id for r in stages[2][1].collect()} == want


def test_decontamination_against_containment(spark, stages):
    items = [r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r.doc_id: f" {' '.join(r.text.lower().split())} " for r in stages[2][1].collect()}
    held = {i for i, t in texts.items() if any(f" {' '.join(w)} " in t for w in items)}
    kept = {r.doc_id for r in stages[3][1].collect()}
    assert held and not held & kept and len(kept) >= 0.98 * (len(texts) - len(held))


def test_pseudonyms_follow_lengths(stages):
    assert all(r.n_chars == len(r.text) for r in stages[4][1].collect())


def test_packing_of_all_that_is_left(stages):
    rows = stages[5][1].collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in stages[4][1].collect()}


def test_run_gives_the_same(spark, stages):
    import corpus_pipeline as c
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, c.run(spark, SF).select(key).collect())) == sorted(
        map(tuple, stages[5][1].select(key).collect()))


def test_queries_equal_their_sql(spark):
    import duckdb

    from shelfspark.llm import catalog
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in catalog.STATEMENTS.items():
        df = catalog.QUERIES[name](spark, SF)
        cols = sorted(df.columns)
        got = sorted((tuple(r) for r in df.select(cols).collect()), key=str)
        want = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall(), key=str)
        assert got == want, name
