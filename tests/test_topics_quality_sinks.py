"""Topic fan-out/replay, quality report, parquet/table/JSON sinks and sources."""

import json
import uuid

from pyspark.sql import functions as F

from docs import VALID, text_frame
from shelfspark.operators import mart, quality
from shelfspark.session import scratch_path
from shelfspark.sources import fixtures, landing, parquet
from shelfspark.streaming import topics


def test_fan_out_one_user_plus_entries(spark):
    raw = landing.documents_from_text(text_frame(spark, VALID))
    ev = topics.topic_events(raw).collect()
    assert sorted(e.topic for e in ev) == ["raw_media", "raw_user"]
    user = json.loads([e.value for e in ev if e.topic == "raw_user"][0])
    assert user["id"] == 7 and user["name"] == "viewer"
    entry = json.loads([e.value for e in ev if e.topic == "raw_media"][0])
    assert entry["id"] == 11 and entry["media"]["id"] == 500


def test_topic_log_replay(spark, small_models):
    ev = topics.topic_events(small_models.raw)
    log = scratch_path(spark, f"t-log-{uuid.uuid4().hex}")
    topics.write_topic_log(ev, log)
    out = scratch_path(spark, f"t-out-{uuid.uuid4().hex}")
    counts = {r.topic: (r.events, r.decoded) for r in
              topics.replay_counts(topics.replay_topic_log(spark, log, out + "/d", out + "/c")).collect()}
    n_docs = small_models.raw.count()
    n_entries = small_models.entries.count()
    assert counts == {"raw_user": (n_docs, n_docs), "raw_media": (n_entries, n_entries)}


def test_quality_report_all_pass(small_models):
    report = quality.quality_report(quality.standard_checks(small_models))
    rows = report.collect()
    assert len(rows) == 17 and all(r.passed for r in rows)
    quality.assert_passed(report)


def test_preview_drops_nested(small_models):
    p = quality.preview(small_models.fact)
    assert "stats" not in p.columns and p.count() == 5


def test_json_landing_roundtrip(spark):
    root = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
    docs = fixtures.build_documents(spark, "/root/testdata/sf0.001")
    landing.land_json(docs, root)
    back = landing.read_landed(spark, root, run_id=fixtures.FIXTURE_RUN_ID)
    assert back.count() == docs.count()
    assert back.exceptAll(docs).count() == 0
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "run_id" in plan


def test_parquet_and_table_sinks(spark, small_models):
    path = scratch_path(spark, f"mart-{uuid.uuid4().hex}")
    parquet.write_parquet(small_models.mart, path)
    assert parquet.read_parquet(spark, path).count() == 14583
    name = landing.save_table(small_models.users, "dbt", "dimension_user")
    assert spark.table(name).count() == small_models.users.count()
    view = landing.create_view(small_models.mart, "anime_scores_view")
    assert view.where(F.col("score") > 0).count() > 0


def test_raw_table_partition_pruning(spark):
    path = scratch_path(spark, f"raw-{uuid.uuid4().hex}")
    landing.write_raw_table(fixtures.build_documents(spark, "/root/testdata/sf0.001"), path)
    df = landing.read_raw_table(spark, path, run_id="fixture").select("doc_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan
    assert df.count() == 150


def test_bucketed_models_colocate_user_join(spark, small_models):
    from shelfspark.operators import scores
    root = scratch_path(spark, f"models-{uuid.uuid4().hex}")
    mm = small_models.materialize(root, buckets=4, database="test_models")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = scores.count_scores_by_top_from_facts(mm.fact, mm.users, mm.media, "genre", 10)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        i = next(n for n, line in enumerate(lines) if "SortMergeJoin" in line and "LeftSemi" in line)
        depth = len(lines[i]) - len(lines[i].lstrip(" :+-*"))
        subtree = []
        for line in lines[i + 1:]:
            if len(line) - len(line.lstrip(" :+-*")) <= depth:
                break
            subtree.append(line)
        # both sides of the user join are bucketed scans: no exchange below it
        assert sum("Scan parquet" in line or "FileScan" in line for line in subtree) == 2
        assert not any("Exchange" in line for line in subtree)
        assert df.collect() == scores.count_scores_by_top(small_models.mart, "genre", 10).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_streaming_fan_out_then_replay(spark, small_models):
    landed = scratch_path(spark, f"s-landed-{uuid.uuid4().hex}")
    landing.land_json(small_models.raw, landed)
    log = scratch_path(spark, f"s-log-{uuid.uuid4().hex}")
    q = topics.stream_documents_to_topic_log(spark, landed, log, log + "_ckpt")
    q.awaitTermination()
    out = scratch_path(spark, f"s-out-{uuid.uuid4().hex}")
    counts = {r.topic: r.events for r in
              topics.replay_counts(topics.replay_topic_log(spark, log, out + "/d", out + "/c")).collect()}
    assert counts == {"raw_user": small_models.raw.count(), "raw_media": small_models.entries.count()}
    # a second drain over the same checkpoint finds nothing new
    q2 = topics.stream_documents_to_topic_log(spark, landed, log, log + "_ckpt")
    q2.awaitTermination()
    assert spark.read.text(log).count() == sum(counts.values())


def test_stg_checks_read_one_leaf_of_raw_table(spark, small_models):
    from shelfspark.plans.models import Models
    path = scratch_path(spark, f"raw-{uuid.uuid4().hex}")
    landing.write_raw_table(small_models.raw, path)
    from shelfspark.plans.models import raw_table_reader
    m = Models(landing.read_raw_table(spark, path))
    m.raw_reader = raw_table_reader(spark, path)
    presence = m.stg_presence()
    plan = presence._jdf.queryExecution().executedPlan().toString()
    assert "entries" not in plan[plan.index("ReadSchema"):]  # whole documents are not read
    rows = quality.quality_report(quality.standard_checks(m)).collect()
    assert all(r.passed for r in rows) and len(rows) == 17



def test_narrow_fact_equals_full_fact(spark, small_models):
    from shelfspark.plans.models import Models, raw_table_reader
    path = scratch_path(spark, f"raw-{uuid.uuid4().hex}")
    landing.write_raw_table(small_models.raw, path)
    m = Models(landing.read_raw_table(spark, path))
    m.raw_reader = raw_table_reader(spark, path)
    narrow = m.narrow_fact()
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "genres" not in plan and "synonyms" not in plan  # arrays not read for the fact
    assert narrow.exceptAll(m.fact).count() == 0 and m.fact.exceptAll(narrow).count() == 0



def test_topic_counts_from_narrowed_read(spark, small_models):
    from shelfspark import schemas
    from shelfspark.plans.models import raw_table_reader
    path = scratch_path(spark, f"raw-{uuid.uuid4().hex}")
    landing.write_raw_table(small_models.raw, path)
    narrow = raw_table_reader(spark, path)(schemas.EVENT_COUNT_RAW_SCHEMA)
    a = sorted(topics.topic_counts(topics.topic_events(narrow)).collect())
    b = sorted(topics.topic_counts(topics.topic_events(small_models.raw)).collect())
    assert a == b


def test_write_counts_equal_a_scan(spark):
    """The checks from a write's counts are those of a scan, on failing, empty and good tables."""
    rows = [(1, "a"), (1, None), (None, "b"), (None, None), (3, "c")]
    df = spark.createDataFrame(rows, "id long, name string")
    spec = quality.TableChecks("t", not_null=["id", "name"], unique=["id"], non_empty=True, expected_rows=5)
    for table in (df, df.where("id > 5"), df.where("id = 3")):
        path = scratch_path(spark, f"observed-{uuid.uuid4().hex}")
        written, seen = quality.observed(table.repartition(3), spec)
        written.write.parquet(path)
        got = quality.observed_checks(seen, spec, spark.read.parquet(path))
        want = quality.check_table(table, spec)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ReadSchema: struct<id:bigint>") == plan.count("ReadSchema:") >= 1


def test_mart_keys_count_the_mart(spark, small_models):
    """Every mart row is counted by its keys, also with repeated ids, null keys and media without arrays."""
    m = small_models
    for keep in ("true", "id % 3 = 0", "false"):
        fact, users, media = m.fact, m.users.unionByName(m.users.where("id % 2 = 0")), m.media.where(keep)
        fact = fact.withColumn("user_id", F.when(F.col("id") % 5 > 0, F.col("user_id")))
        media = (media.withColumn("genres", F.when(F.col("id") % 2 > 0, F.col("genres")))
                 .withColumn("tags", F.when(F.col("id") % 4 > 0, F.col("tags")))
                 .withColumn("synonyms", F.when(F.col("id") % 8 > 0, F.col("synonyms"))))
        keys = mart.mart_keys(fact, users, media)
        assert (keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
                == mart.anime_scores(fact, users, media).count())
    plan = mart.mart_keys(m.fact, m.users, m.media)._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_zip" not in plan
