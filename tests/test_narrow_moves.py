"""What moves between tasks is narrow: documents, media winners, the raw table written once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfspark.operators.models import latest_per_key, possible_winners
from shelfspark.plans import models
from shelfspark.sources import fixtures

DAY = dt.datetime(2020, 1, 2)


def write_tables(spark, root, customers=(1, 2), parts=(1, 2, 3)):
    tables = {
        "orders": ([(k, k % 3 + 1, "FOP"[k % 3], DAY) for k in range(30)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp"),
        "lineitem": ([(k, k * 7 % 4 + 1, float(k % 50), DAY) for k in range(30)],
                     "l_orderkey long, l_partkey long, l_quantity double, l_shipdate timestamp"),
        "customer": ([(c, f"c{c}", 3, "SEG") for c in customers],
                     "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "part": ([(p, f"red p{p}", "B1", "T1", 7 + p) for p in parts],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}.parquet")


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.mark.parametrize("build", [fixtures.build_documents, fixtures.build_dirty_documents_text])
def test_documents_are_made_after_their_only_exchange(spark, tmp_path, build):
    write_tables(spark, str(tmp_path))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        docs = build(spark, str(tmp_path), max_entries=2)
        plan = plan_of(docs)
        above, below = plan.split("REPARTITION_BY_COL", 1)
        assert "cover/" in above and "cover/" not in below
        assert above.count("Exchange ") == 1  # that exchange: documents do not move to their user
        assert docs.count() > 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_no_key_moves_or_is_stored_twice(spark, tmp_path):
    """The entry's id, user, media and status are made of what the document and its lists are keyed by."""
    sf = str(tmp_path)
    write_tables(spark, sf)
    staged = str(tmp_path / "staged")
    docs = fixtures.build_documents(spark, sf, staging_path=staged)
    assert "entry_id" not in spark.read.parquet(staged).columns
    narrow = fixtures.entry_struct(fixtures.numbered(spark.read.parquet(staged), 2),
                                   fixtures.media_struct(spark.read.parquet(f"{sf}/part.parquet")))
    assert not {"entry_id", "user_id", "media_id", "status", "media"} & set(narrow.schema["entry"].dataType.names)
    entries = docs.select(F.col("data.User.id").alias("u"), F.explode("data.MediaListCollection.lists").alias("l"))
    got = entries.select("u", "l.status", F.explode("l.entries").alias("e")).collect()
    assert len(got) > 5
    for r in got:
        assert (r.e.id, r.e.userId, r.e.status) == ((r.u << 32) + r.e.media.id, r.u, r.status)
        assert r.e.mediaId == r.e.media.id


def test_days_and_ranks_move_to_the_entries(spark, tmp_path):
    write_tables(spark, str(tmp_path))
    plan = plan_of(fixtures.entry_facts(*(spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("lineitem", "orders"))))
    below = plan.split("HashAggregate")[2]  # the partial aggregate's input
    assert "bool_or" not in plan and "cast(o_orderdate" in below and "cast(l_shipdate" in below
    rows = [(1, "F", 3, 9), (1, "A", 1, 5), (2, "F", 2, 2), (2, "G", 5, 1), (3, "O", 1, 1), (3, "F", 4, 8), (4, None, 6, 6),
            (5, "O", 1, 1), (5, "P", 2, 2), (6, None, 1, 1), (6, "O", 1, 1), (7, "A", 1, 1)]
    day = lambda d: dt.datetime(2020, 1, d, 23, 59)
    orders = spark.createDataFrame([(k, c, s, day(d)) for k, (c, s, d, _) in enumerate(rows)],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp")
    lines = spark.createDataFrame([(k, 1, 2.0, day(d)) for k, (_, _, _, d) in enumerate(rows)],
                                  "l_orderkey long, l_partkey long, l_quantity double, l_shipdate timestamp")
    got = {r.user_id: (r.status, r.started.day, r.completed.day) for r in fixtures.entry_facts(lines, orders).collect()}
    assert got == {1: ("COMPLETED", 1, 9), 2: ("PLANNING", 2, 2), 3: ("CURRENT", 1, 8), 4: ("PLANNING", 6, 6),
                   5: ("PLANNING", 1, 2), 6: ("CURRENT", 1, 1), 7: ("PLANNING", 1, 1)}


def test_whole_rows_of_winners_only(spark):
    rows = [(k % 7 if k % 11 else None, "r", k * 37 % 1000, k, "x" * 50 + str(k)) for k in range(2000)]
    df = spark.createDataFrame(rows, "id long, run_id string, doc_id long, entry_id long, text string").repartition(5)
    order = ["run_id", "doc_id", "entry_id"]
    best = {}
    for r in rows:
        best[r[0]] = max(best.get(r[0], r), r, key=lambda x: x[1:4])
    got = {r.id: r.text for r in latest_per_key(df, "id", order, ["text"]).collect()}
    assert got == {k: r[4] for k, r in best.items()}
    kept = possible_winners(df, "id", order, df.select("id", *order)).collect()
    assert {r.text for r in kept} >= {r[4] for r in best.values()} and len(kept) <= 12


def test_raw_table_is_written_once_and_again_when_a_table_changes(spark, tmp_path):
    sf = str(tmp_path)
    write_tables(spark, sf)
    first = models.stored_documents(spark, sf)
    assert models.stored_documents(spark, sf + "/") == first
    m = models.Models.for_tables(spark, sf)
    lazy = models.Models(fixtures.build_documents(spark, sf))
    for name in ("fact", "users", "media"):
        assert sorted(map(str, getattr(m, name).collect())) == sorted(map(str, getattr(lazy, name).collect())), name
    assert {r.id for r in m.users.collect()} == {1, 2}
    write_tables(spark, sf, customers=(1, 2, 3), parts=(2, 3, 4))
    assert models.stored_documents(spark, sf) != first
    m = models.Models.for_tables(spark, sf)
    assert {r.id for r in m.users.collect()} == {1, 2, 3} and {r.id for r in m.media.collect()} == {2, 3, 4}


def test_dirty_text_is_json_with_its_rules(spark, tmp_path):
    write_tables(spark, str(tmp_path))
    clean = fixtures.build_documents(spark, str(tmp_path)).select(F.explode(F.flatten("data.MediaListCollection.lists.entries")).alias("e"))
    rules = {r: F.from_json(fixtures.dirty_entry_json(F.col("e").withField("id", F.lit(97 + r).cast("long")), faults=True),
                            "score variant, progress variant, startedAt variant, media variant") for r in range(11)}
    row = clean.select(*[F.to_json(c).alias(f"r{r}") for r, c in rules.items()], F.col("e.score").alias("score")).first()
    whole = str(int(row.score))
    assert f'"score":{whole},' in row.r0 and f'"score":{whole}.5,' in row.r1 and f'"score":"{whole}",' in row.r6
    assert '"progress"' not in row.r2 and '"progress":null' in row.r3 and '"progress":[3]' in row.r9
    assert '"day":30' in row.r4 and '"month":0' in row.r5 and '"extraLarge"' not in row.r7
    assert '"score":"eight"' in row.r8 and '"episodes":"twelve"' in row.r10
    assert all('"stats":{}' in row[f"r{r}"] and '"rankings":[]' in row[f"r{r}"] for r in range(11))


def test_a_media_without_size_is_built(spark):
    part = spark.createDataFrame([(5, "red p", "B1", "T1", None)],
                                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    got = fixtures.media_struct(part).select(
        F.transform(F.array("media"), fixtures.media_value)[0].alias("m")).select("m.season", "m.id", "m.genres").first()
    assert tuple(got) == ("FALL", 5, ["T1", "red"])


def test_the_typed_read_parses_the_members_of_its_schema_only(spark):
    from docs import entry_path, media_path, text_frame, variant
    from shelfspark import schemas
    from shelfspark.plans.models import Models
    from shelfspark.sources import landing
    lines = text_frame(spark, variant(), variant(**{"doc_id": 2, media_path("averageScore"): "71.5"}),
                       variant(**{"doc_id": 3, entry_path("score"): "7", media_path("episodes"): 2.5}))
    narrow = landing.documents_from_text(lines, schema=schemas.FACT_RAW_SCHEMA)
    assert "genres" not in narrow.schema.simpleString() and "run_id" in narrow.columns
    whole = landing.documents_from_text(lines)
    rows = [sorted(map(str, Models(d, strict_dates=False).fact.collect())) for d in (narrow, whole)]
    assert rows[0] == rows[1] and len(rows[0]) == 3


def test_checked_users_are_parsed_once(spark):
    from docs import text_frame, variant
    from shelfspark.plans.models import ValidatedModels
    from shelfspark.sources import landing
    lines = text_frame(spark, variant(), variant(doc_id=2, data__User__name="later"), variant(doc_id=3, data__User__name=5))
    users = ValidatedModels(landing.variant_documents_from_text(lines), lines).users
    read = users.inputFiles()
    assert read and all("/checked-users-" in f for f in read)
    assert [(r.id, r.name) for r in users.collect()] == [(7, "later")]


def test_documents_of_many_entries_are_dealt_to_enough_tasks(spark, tmp_path, monkeypatch):
    """Tasks follow the entries, not the session's partitions; each document is gathered in one grouping."""
    write_tables(spark, str(tmp_path))
    whole = sorted(map(str, fixtures.build_documents(spark, str(tmp_path), max_entries=2).collect()))
    monkeypatch.setattr(fixtures, "ENTRIES_PER_TASK", 1)
    docs = fixtures.build_documents(spark, str(tmp_path), max_entries=2, staging_path=str(tmp_path / "staged"))
    n = spark.read.parquet(str(tmp_path / "staged")).count()
    plan = plan_of(docs)
    assert n > 8 and docs.rdd.getNumPartitions() == n
    assert "REPARTITION_BY_NUM" in plan and plan.count("collect_list") == 2  # partial and final
    assert sorted(map(str, docs.collect())) == whole


def test_the_few_users_of_many_documents_are_broadcast(spark, tmp_path):
    """They are written, so their size is known: the facts do not move to them."""
    write_tables(spark, str(tmp_path))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        docs = fixtures.build_documents(spark, str(tmp_path), max_entries=2, staging_path=str(tmp_path / "staged"))
        plan = plan_of(docs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    joins = [line for line in plan.splitlines() if "Join" in line and "many_user" in line]
    assert len(joins) == 2 and all("BroadcastHashJoin" in line for line in joins)
    assert any("/staged-many/" in f for f in docs.inputFiles())


def test_the_written_users_of_many_documents_are_right(spark, tmp_path):
    write_tables(spark, str(tmp_path))
    _, many, _ = fixtures._numbered_entries(spark, str(tmp_path), 2, str(tmp_path / "staged"))
    assert {(r.many_user, r.n_chunks) for r in many.collect()} == {
        (r.user_id, -(-r["count"] // 2)) for r in spark.read.parquet(str(tmp_path / "staged")).groupBy("user_id").count()
        .collect() if r["count"] > 2}


def test_shuffles_are_sized_by_rows_and_the_session_is_left_as_it_was(spark):
    from shelfspark import session
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k, None) for k in keys]
    with pytest.raises(ZeroDivisionError), session.shuffles_for(spark, 40 * session.ROWS_PER_TASK + 1):
        assert spark.conf.get(keys[0]) == "41" and spark.conf.get(keys[1]) == str(before[1] or session.BYTES_PER_TASK)
        1 / 0
    assert [spark.conf.get(k, None) for k in keys] == before
    with session.shuffles_for(spark, 10):
        assert [spark.conf.get(k, None) for k in keys] == before


def test_the_rows_of_the_fits_are_joined_once(spark, tmp_path):
    from shelfspark.plans import catalog
    write_tables(spark, str(tmp_path))
    for name in ("category_index", "genre_scale", "tag_scale"):
        df = catalog.QUERIES[name](spark, str(tmp_path))
        assert all("/tag-genre-pairs-" in f for f in df.inputFiles()) and "Join" not in plan_of(df), name


def test_media_move_to_their_scores_before_they_are_multiplied(spark, tmp_path):
    from shelfspark.plans import catalog
    write_tables(spark, str(tmp_path))
    plan = plan_of(catalog.QUERIES["tag_genre_pairs"](spark, str(tmp_path)))
    above, below = plan.split("Join", 1)
    assert "Generate explode" in above and "transform(_tags" in above and "flatten" in above
