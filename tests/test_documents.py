"""Documents at scale, their size as text, saved tables and the stream's state."""

import json
import time
import uuid

from pyspark.sql import functions as F

from shelfspark.plans.models import Models
from shelfspark.session import scratch_path
from shelfspark.sources import fixtures, landing
from shelfspark.streaming import topics

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_a_heavy_users_documents_are_built_in_many_tasks(spark):
    """All documents of a user come from an exchange by document, none is grouped by user."""
    facts = (fixtures.entry_facts(spark.read.parquet(f"{SF}/lineitem.parquet"), spark.read.parquet(f"{SF}/orders.parquet"))
             .withColumn("user_id", F.when(F.col("entry_id") >= 0, 7).otherwise(8).cast("long")))
    numbered = fixtures.numbered(facts, 50)
    counts = [r["count"] for r in numbered.groupBy("chunk").count().collect()]
    assert len(counts) == -(-sum(counts) // 50) and max(counts) < 100
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        media = fixtures.media_struct(spark.read.parquet(f"{SF}/part.parquet"))
        users = fixtures.user_struct(spark.read.parquet(f"{SF}/customer.parquet"))
        docs = fixtures.nest_documents(fixtures.entry_struct(numbered, media), users)
        plan = _plan(docs)
        # nothing but that exchange between the entries and their documents
        nested = plan[:plan.index("REPARTITION_BY_COL")]
        assert plan.count("REPARTITION_BY_COL") == 1 and "chunk" in nested.rsplit("hashpartitioning", 1)[1]
        assert nested.count("Exchange hashpartitioning") == 1 + ("SortMergeJoin" in nested)
        assert docs.count() == len(counts)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_numbering_joins_users_of_many_documents_only(spark):
    facts = spark.createDataFrame([(u << 32 | i, u) for u, n in ((1, 3), (2, 11), (3, 0)) for i in range(n)],
                                  "entry_id long, user_id long")
    got = {(r.user_id, r.chunk) for r in fixtures.numbered(facts, 5).collect()}
    assert {c for u, c in got if u == 1} == {0} and {c for u, c in got if u == 2} <= {0, 1, 2}
    assert fixtures.numbered(facts, 5).count() == 14


def test_size_is_that_of_dumped_text(spark):
    values = [{}, [], {"a": 1, "b": [1, 2.5, None, True]}, {"k,:": "x: y, z", "q": 'say "a, b: c"', "s": "back\\slash"},
              {"e": "\u00e9\u4e2d", "w": "\U0001f600 \U00010000", "del": "\u007f", "t": "tab\tand\nline"},
              {"deep": {"deep": [{"x": "]}{["}, {"y": ","}]}}, "text", 7]
    lines = [json.dumps(v, separators=(",", ":"), ensure_ascii=False) for v in values]
    rows = spark.createDataFrame([(x, len(json.dumps(v).encode())) for x, v in zip(lines, values)], "value string, n int")
    assert [r.got for r in rows.select(landing.dumped_size(F.col("value")).alias("got"), "n").collect()] == [
        r.n for r in rows.collect()]


def test_size_of_landed_documents(spark):
    root = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
    landing.land_json(fixtures.build_documents(spark, SF), root)
    want = {json.loads(r.value)["doc_id"]: len(json.dumps(json.loads(r.value)).encode())
            for r in landing.read_landed_text(spark, root).collect()}
    got = {r.id: r.n_bytes for r in landing.read_landed_variant(spark, root)
           .select(F.expr("variant_get(doc, '$.doc_id', 'bigint')").alias("id"), "n_bytes").collect()}
    assert got == want


def test_view_outlasts_the_session_that_made_it(spark, small_models):
    m = small_models
    schema = f"shelf_{uuid.uuid4().hex[:8]}"
    for name, df in (("fact_anime", m.fact), ("dimension_user", m.users), ("dimension_media", m.media)):
        landing.save_table(df, schema, name, scratch_path(spark, f"{schema}-{name}"))
    view = landing.create_mart_view(spark, schema)
    other = spark.newSession()
    seen, want = other.table(view), m.mart_wide
    assert seen.columns == want.columns and seen.count() == want.count() > 0
    # the view reads its tables as they are, in a session that has no files listed yet
    landing.save_table(m.fact.where("score > 5"), schema, "fact_anime", scratch_path(spark, f"{schema}-again"))
    assert spark.newSession().table(view).count() == want.where("score > 5").count()


def test_null_arrays_in_the_view(spark):
    schema = f"shelf_{uuid.uuid4().hex[:8]}"
    from shelfspark import schemas
    media = spark.createDataFrame([(1, None), (2, ["g", "h"])], "id long, genres array<string>")
    full = media.select("id", "genres", *[F.lit(None).cast(
        "array<struct<name: string>>" if c == "tags" else "array<string>" if c == "synonyms"
        else "struct<english: string, native: string, romaji: string>" if c == "title" else "string").alias(c)
        for c in schemas.MEDIA_COLUMNS if c not in ("id", "genres")])
    fact = spark.createDataFrame([(1, 9, 1), (2, 9, 2)], "id long, user_id long, media_id long").select("*", *[
        F.lit(None).cast("double").alias(c) for c in schemas.FACT_COLUMNS if c not in ("id", "user_id", "media_id")])
    user = spark.createDataFrame([(9, "u")], "id long, name string")
    for name, df in (("fact_anime", fact), ("dimension_user", user), ("dimension_media", full)):
        landing.save_table(df, schema, name, scratch_path(spark, f"{schema}-{name}"))
    rows = spark.table(landing.create_mart_view(spark, schema)).select("id_1", "genre", "tag", "synonym").collect()
    assert sorted(map(tuple, rows)) == [(2, "g", None, None), (2, "h", None, None)]


def test_stream_sends_a_user_once_and_forgets_it(spark):
    root, log, checkpoint = (scratch_path(spark, f"{x}-{uuid.uuid4().hex}") for x in ("landed", "log", "checkpoint"))
    docs = fixtures.build_documents(spark, SF, max_entries=20)  # several documents a user
    users = docs.select("data.User.id").distinct().count()

    def drain(remember):
        q = topics.stream_documents_to_topic_log(spark, root, log, checkpoint, remember=remember)
        q.awaitTermination()
        return [op for p in q.recentProgress for op in p.stateOperators]

    landing.land_json(docs, root)
    held = drain("1 second")
    counts = {r.topic: r.events for r in topics.topic_counts(spark.read.format("text").load(log)).collect()}
    assert counts["raw_user"] == users and held[0].numRowsTotal == users
    # later runs move the watermark on: users of the first one leave the state
    time.sleep(2)
    for run in ("r2", "r3"):
        landing.land_json(docs.where("data.User.id < 10").withColumn("run_id", F.lit(run)), root)
        held = drain("1 second")
        time.sleep(2)
    assert held[-1].numRowsTotal < users
