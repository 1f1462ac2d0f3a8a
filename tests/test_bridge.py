"""The bridge gives the same results whatever the size of documents and ids."""

import datetime as dt

import pytest

from shelfspark.plans.models import Models
from shelfspark.operators import validate
from shelfspark.sources import fixtures, landing
from shelfspark.streaming import topics

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole_and_split(spark, tmp_path_factory):
    out = []
    for n in (fixtures.DEFAULT_MAX_ENTRIES, 10):
        docs = fixtures.build_documents(spark, SF, max_entries=n)
        root = str(tmp_path_factory.mktemp("landed"))
        landing.land_json(docs, root)
        out.append((landing.read_landed(spark, root), landing.read_landed_variant(spark, root)))
    return out


def test_results_do_not_depend_on_the_document_size(whole_and_split):
    (a, av), (b, bv) = whole_and_split
    assert b.count() > a.count()
    rows = [(sorted((r.topic, r.value) for r in topics.topic_events(x).collect()),
             sorted(map(tuple, validate.user_envelope_check(validate.raw_envelope_check(v)).collect())),
             sorted(map(str, Models(x).fact.collect())), sorted(map(str, Models(x).users.collect())))
            for x, v in ((a, av), (b, bv))]
    for one, other in zip(*rows):
        assert one == other


def test_large_part_keys_and_long_statuses(spark):
    day = dt.datetime(2020, 1, 1)
    orders = spark.createDataFrame([(1, 1, "F", day), (2, 2, "FX", day), (3, 1, "O", day), (4, 3, "P", day),
                                    (5, 4, "OK", day), (6, 5, "A", day)],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp")
    lines = spark.createDataFrame([(k, p, 1.0, day) for k, p in ((1, 1_000_001), (2, 1), (3, 7), (4, 5), (5, 5), (6, 5))],
                                  "l_orderkey long, l_partkey long, l_quantity double, l_shipdate timestamp")
    got = {(r.user_id, r.media_id): r for r in fixtures.entry_facts(lines, orders).collect()}
    assert len({r.entry_id for r in got.values()}) == len(got)
    assert {k: r.status for k, r in got.items()} == {
        (1, 1_000_001): "COMPLETED", (2, 1): "PLANNING", (1, 7): "CURRENT", (3, 5): "PLANNING", (4, 5): "PLANNING",
        (5, 5): "PLANNING"}


def test_date_parts_are_read_in_order(spark):
    from docs import entry_path, text_frame, variant
    cases = [({"year": None}, []), ({"year": 0, "month": 3}, []), ({"year": 2020, "month": 0}, []),
             ({"month": 3, "day": 1}, ["startedAt:missing_part"]),
             ({"year": 2020, "day": 1}, ["startedAt:missing_part"]),
             ({"year": 2020, "month": 2.5, "day": 1}, ["startedAt:invalid_date"]),
             ({"year": 2020, "month": 2, "day": 30}, ["startedAt:invalid_date"]),
             ({"year": 2020, "month": 2, "day": 29}, [])]
    lines = text_frame(spark, *[variant(**{"doc_id": i, entry_path("startedAt"): c}) for i, (c, _) in enumerate(cases)])
    got = {r.doc_id: r for r in validate.checked_facts(validate.record_entries_from_text(lines)).collect()}
    for i, (_, errors) in enumerate(cases):
        assert got[i].errors == errors, cases[i]
    assert got[7].started_at == "2020-02-29" and got[0].started_at is None
