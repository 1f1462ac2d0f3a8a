"""The gated build job."""

import json
import uuid

import pytest

from docs import DELETE, entry_path, media_path, variant
from shelfspark.plans import jobs
from shelfspark.session import scratch_path
from shelfspark.sources import fixtures, landing


def test_build_job_writes_outputs(spark):
    landed = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
    landing.land_json(fixtures.build_documents(spark, "/root/testdata/sf0.001"), landed)
    out = scratch_path(spark, f"build-{uuid.uuid4().hex}")
    summary = jobs.build(spark, landed, fixtures.FIXTURE_RUN_ID, out)
    assert summary["documents"] == 150
    report = spark.read.parquet(f"{out}/quality_report").collect()
    assert all(r.passed for r in report) and len(report) == 18
    assert spark.read.parquet(f"{out}/anime_scores.parquet").count() == 14583


def test_build_job_blocks_on_invalid_envelope(spark):
    landed = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
    spark.createDataFrame([("bad", json.dumps({}))], "run_id string, value string") \
        .write.partitionBy("run_id").text(landed)
    out = scratch_path(spark, f"build-{uuid.uuid4().hex}")
    with pytest.raises(jobs.GateFailed, match="raw_anilist validation failed"):
        jobs.build(spark, landed, "bad", out)


def _landed(spark, lines):
    landed = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
    spark.createDataFrame([("r", x) for x in lines], "run_id string, value string") \
        .write.partitionBy("run_id").text(landed)
    return landed


def test_build_keeps_numbers_given_as_text_or_fraction(spark):
    d = variant(**{entry_path("score"): "8", entry_path("progress"): "3", media_path("episodes"): 24.0})
    out = scratch_path(spark, f"build-{uuid.uuid4().hex}")
    jobs.build(spark, _landed(spark, [json.dumps(d)]), "r", out)
    row = spark.read.parquet(f"{out}/models/fact_anime").first()
    assert (row.score, row.progress, row.episodes) == (8.0, 3, 24)


def test_values_that_cannot_be_cast_fail_the_build_unless_lenient(spark):
    bad = {entry_path("score"): "eight", entry_path("progress"): [3], media_path("episodes"): "twelve"}
    landed, out = _landed(spark, [json.dumps(variant(**bad))]), scratch_path(spark, f"build-{uuid.uuid4().hex}")
    with pytest.raises(jobs.GateFailed) as failed:
        jobs.build(spark, landed, "r", out)
    for path in ("entries[*].score (1)", "entries[*].progress (1)", "media.episodes (1)"):
        assert path in str(failed.value)
    jobs.build(spark, landed, "r", out + "-lenient", strict_casts=False)
    row = spark.read.parquet(f"{out}-lenient/models/fact_anime").first()
    assert (row.score, row.progress, row.episodes) == (None, None, None)


def test_no_faults_in_what_can_be_cast(spark):
    good = {entry_path("score"): "8.5", entry_path("progress"): None, media_path("episodes"): 24.0}
    docs = landing.documents_from_text(_landed_lines(spark, [
        json.dumps(variant(**good)), "{}", '{"doc_id": "7"}', '{"doc_id": "x", "data": {"User": {"id": true}}}']), faults=True)
    got = [(r.path, r.n) for r in landing.cast_faults(docs).collect()]
    assert ("$.doc_id", 1) in got and all(p in ("$.doc_id", "$.data.User.id") for p, _ in got)


def test_impossible_date_is_a_failed_gate_unless_lenient(spark):
    d = variant(**{entry_path("startedAt"): {"year": 2023, "month": 2, "day": 30}})
    landed, out = _landed(spark, [json.dumps(d)]), scratch_path(spark, f"build-{uuid.uuid4().hex}")
    with pytest.raises(jobs.GateFailed, match="impossible date"):
        jobs.build(spark, landed, "r", out)
    jobs.build(spark, landed, "r", out + "-lenient", strict_dates=False)
    assert spark.read.parquet(f"{out}-lenient/models/fact_anime").first().started_at is None


def test_validated_build_and_document_quarantine(spark):
    docs = [variant(doc_id=0), variant(**{"doc_id": 1, entry_path("score"): "x"}),
            variant(**{"doc_id": 2, "data__User": DELETE}), variant(**{"doc_id": 3, entry_path("media"): DELETE})]
    lines = [json.dumps(d) for d in docs] + ['{"doc_id": 9, "data": {"Me']
    out = scratch_path(spark, f"validated-{uuid.uuid4().hex}")
    landed = _landed(spark, lines)
    with pytest.raises(jobs.GateFailed):
        jobs.build_validated(spark, landed, "r", out)
    rows = jobs.build_validated(spark, landed, "r", out, envelope_gate=False)
    reasons = sorted((r.reason, r.doc_id) for r in spark.read.parquet(f"{out}/document_quarantine").collect())
    assert [r for r, _ in reasons] == ["no_user", "structure", "unparsable"] and reasons[0][1] == 2
    errors = [(r.model, r.doc_id, r.errors) for r in spark.read.parquet(f"{out}/quarantine").collect()]
    assert ("fact_anime", 1, ["score:not_int"]) in errors
    assert rows["document_quarantine"] == 3 and rows["fact_anime"] >= 1


def test_two_bucketed_builds_do_not_meet(spark):
    from shelfspark.plans.models import Models
    outs = []
    for i in (1, 2):
        raw = landing.documents_from_text(_landed_lines(spark, [json.dumps(variant(doc_id=k)) for k in range(i)]))
        root = scratch_path(spark, f"bucketed-{uuid.uuid4().hex}")
        outs.append(Models(raw).materialize(root, buckets=2))
    counts = [o.fact.count() for o in outs]
    assert counts[1] == 2 * counts[0]


def _landed_lines(spark, lines):
    return spark.createDataFrame([("r", x) for x in lines], "run_id string, value string")
