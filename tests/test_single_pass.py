"""Texts are parsed once, checked no further than needed, and logs are kept small."""

import json
import re

import pytest
from pyspark.sql import functions as F

from shelfspark import schemas
from shelfspark.operators import validate
from shelfspark.plans import catalog
from shelfspark.sources import landing
from shelfspark.streaming import topics

SF_SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


# ---------------------------------------------------------------- cast faults

def entry(**members):
    media = {"id": 5, "episodes": 12, "tags": [{"rank": "first"}], "startDate": {"year": 2001, "month": 2, "day": 3},
             "genres": ["a"], "title": {"english": "x"}} | members.pop("media", {})
    return {"id": 1, "progress": 2, "score": 7, "mediaId": 5, "userId": 9, "media": media} | members


def line(*entries, **data):
    body = {"MediaListCollection": {"lists": [{"name": "n", "status": "s", "entries": list(entries)}]},
            "User": {"id": 9, "name": "u"}} | data
    return json.dumps({"doc_id": 4, "data": body})


FAULTY = [
    line(entry(), entry(score="eight"), entry(progress=[3])),
    line(entry(score="7.5", progress="12", id=2.0, mediaId=1e30), entry(media={"episodes": "twelve"})),
    line(entry(media={"startDate": {"year": "x", "month": None, "day": 2.5}, "genres": "no list", "title": 3})),
    line(entry(progress=True, userId={"a": 1}), User={"id": "nine"}), line(entry())[:-9], "[]", "no json", None,
    line(User=None), json.dumps({"doc_id": "d", "data": {"MediaListCollection": {"lists": 3}}}),
]


def faults(spark, schema):
    lines = spark.createDataFrame([("r", t) for t in FAULTY], "run_id string, value string")
    return landing.cast_faults(landing.documents_from_text(lines, faults=True, schema=schema))


def test_cast_faults_parse_a_line_once(spark):
    assert plan_of(faults(spark, schemas.RAW_DOCUMENT)).count("from_json(") == 1
    assert plan_of(faults(spark, schemas.NUMBERS_RAW_SCHEMA)).count("from_json(") == 1


def test_numbers_alone_have_the_faults_of_whole_documents(spark):
    whole = {tuple(r) for r in faults(spark, schemas.RAW_DOCUMENT).collect()}
    assert whole == {tuple(r) for r in faults(spark, schemas.NUMBERS_RAW_SCHEMA).collect()}
    entries = "$.data.MediaListCollection.lists[*].entries[*]"
    assert dict(whole) == {
        f"{entries}.score": 1, f"{entries}.progress": 1, f"{entries}.mediaId": 1, f"{entries}.userId": 1,
        f"{entries}.media.episodes": 1, f"{entries}.media.startDate.year": 1, "$.data.User.id": 1, "$.doc_id": 1}


# ---------------------------------------------------------------- landed documents

def test_the_roundtrip_parses_landed_lines_once(spark):
    plan = plan_of(catalog.q_raw_json_roundtrip(spark, SF_SMALL))
    assert "from_json(" not in plan and "raw-landed-" in catalog.q_raw_json_roundtrip(spark, SF_SMALL).inputFiles()[0]


def test_only_texts_with_escapes_are_searched_for_them(spark):
    texts = ['{"a": 1}', '{"a":"x,y:z","b":[1,2]}', '{"a":"caf\u00e9 \U0001f600","b":"\\"q,"}', '\t{"a":\t1}', "", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string").select(
        landing.dumped_size(F.col("value")).alias("n"))
    assert re.search(r"CASE WHEN (RLIKE\(value|value#\d+ RLIKE)", plan_of(df))
    # a byte a separator, five more for an escaped character, eleven beyond the basic plane
    assert [r.n for r in df.collect()] == [9, 27, 25 + 3 + 5 + 11, 9 + 1 + 5 + 5, 0, None]
    assert json.dumps(json.loads(texts[2])) == '{"a": "caf\\u00e9 \\ud83d\\ude00", "b": "\\"q,"}' and len(json.dumps(json.loads(texts[2]))) == 44


# ---------------------------------------------------------------- validated media

TITLES = [({"english": "e", "native": None, "romaji": "r"}, None), ({"english": "e", "native": None}, "bad_title"),
          ({"english": 1, "native": None, "romaji": "r"}, "bad_title"), (["e"], "bad_title"), ("e", "bad_title"),
          (None, "bad_title"), ({}, "bad_title")]
RANKS = [(3, None), (None, None), (3.0, None), ("3", None), (3.5, "bad_tag"), ("x", "bad_tag"), ([3], "bad_tag"),
         (10 ** 30, "bad_tag")]


def test_titles_and_tags_are_checked_without_the_text_of_their_type(spark):
    def media(title, rank):
        tag = {"category": "c", "description": None, "name": "n", "rank": rank}
        return entry(status="s", media={"title": title, "tags": [tag], "status": "s"})
    wanted = [(t, 3, f"title:{e}" if e else None) for t, e in TITLES]
    wanted += [(TITLES[0][0], r, f"tags:{e}" if e else None) for r, e in RANKS]
    lines = spark.createDataFrame([("r", json.dumps({"doc_id": i, "data": {"MediaListCollection": {"lists": [
        {"entries": [media(t, r)]}]}}})) for i, (t, r, _) in enumerate(wanted)], "run_id string, value string")
    checked = validate.checked_media(validate.record_entries_from_text(lines, validate.MEDIA_KEYS))
    assert "OBJECT" not in plan_of(checked)
    got = {r.doc_id: {e for e in r.errors if e.startswith(("title:", "tags:"))} for r in checked.collect()}
    assert got == {i: {e} if e else set() for i, (_, _, e) in enumerate(wanted)}


# ---------------------------------------------------------------- topic log

EVENTS = [("raw_user", "{}"), ("raw_media", '{"id":1}'), ("raw_media", "no json")]


def names(spark, path, ending):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return [r.path for r in files.where(F.col("path").endswith(ending)).select("path").collect()]


def test_log_and_replay_are_compressed(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    topics.write_topic_log(spark.createDataFrame(EVENTS, "topic string, value string").coalesce(1), log)
    assert len(names(spark, log, ".txt.gz")) == 2 and not names(spark, log, ".txt")
    delivered = topics.replay_topic_log(spark, log, out, str(tmp_path / "checkpoint"))
    assert sorted(map(tuple, topics.replay_counts(delivered).collect())) == [("raw_media", 2, 1), ("raw_user", 1, 1)]
    assert names(spark, out, ".zstd.parquet") and not names(spark, out, ".snappy.parquet")


def test_a_file_of_the_log_holds_a_bounded_number_of_events(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(topics._LOG_FILES, "maxRecordsPerFile", "10")
    log = str(tmp_path / "log")
    topics.write_topic_log(spark.range(35).coalesce(1).select(
        F.lit("raw_media").alias("topic"), F.col("id").cast("string").alias("value")), log)
    assert len(names(spark, log, ".txt.gz")) == 4 and spark.read.text(log).count() == 35


def test_streamed_logs_are_compressed(spark, tmp_path):
    landed, log = str(tmp_path / "landed"), str(tmp_path / "log")
    docs = landing.documents_from_text(spark.createDataFrame([("r", line(entry(score=7.0)))], "run_id string, value string"))
    landing.land_json(docs, landed)
    topics.stream_documents_to_topic_log(spark, landed, log, str(tmp_path / "checkpoint")).awaitTermination()
    assert names(spark, log, ".txt.gz") and not names(spark, log, ".txt")
    got = {tuple(r) for r in topics.topic_counts(spark.read.format("text").load(log)).collect()}
    assert got == {("raw_user", 1), ("raw_media", 1)}
