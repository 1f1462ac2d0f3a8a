"""SQL-mode models on a hand-written document (golden rows) and on an empty one."""

import datetime as dt

import pytest

from docs import VALID, entry_path, text_frame, variant
from shelfspark import schemas
from shelfspark.operators import quality, staging
from shelfspark.plans.models import Models
from shelfspark.sources import landing


def _models(spark, *docs):
    return Models(landing.documents_from_text(text_frame(spark, *docs)))


def test_fact_golden(spark):
    m = _models(spark, VALID)
    rows = [r.asDict() for r in m.fact.collect()]
    assert rows == [{
        "id": 11, "user_id": 7, "media_id": 500, "average_score": 7.2, "mean_score": 7.0,
        "popularity": 900, "trending": 1, "favourites": 12, "progress": 3, "episodes": 24,
        "score": 8.0, "watch_status": "CURRENT", "started_at": None, "completed_at": None,
        "stats": "{}", "rankings": "[]",
    }]
    assert m.fact.columns == schemas.FACT_COLUMNS


def test_media_and_user_golden(spark):
    m = _models(spark, VALID)
    media = m.media.collect()[0].asDict(recursive=True)
    assert media["id"] == 500 and media["genres"] == ["Drama", "Comedy"]
    assert media["cover_image"] == "xl.png" and media["status"] == "FINISHED"
    assert [t["name"] for t in media["tags"]] == ["school", "band", "city"]
    assert media["title"] == {"english": "Show", "native": "SHOW", "romaji": "Sho"}
    assert media["start_date"] is None and media["end_date"] is None
    assert m.media.columns == schemas.MEDIA_COLUMNS
    user = m.users.collect()[0].asDict()
    assert user == {"id": 7, "name": "viewer", "avatar": "avatar.png", "banner_image": "ub.png",
                    "site_url": "user/7", "statistics": "{}"}


def test_dates_from_parts(spark):
    doc = variant(**{entry_path("startedAt"): {"year": 2021, "month": 3, "day": 4},
                     entry_path("completedAt"): {"year": 2021, "month": 3, "day": None}})
    row = _models(spark, doc).fact.collect()[0]
    assert row.started_at == dt.date(2021, 3, 4)
    assert row.completed_at is None


def test_empty_document_gives_no_rows_and_failed_check(spark):
    m = _models(spark, {})
    assert m.fact.count() == 0 and m.media.count() == 0
    report = quality.check_table(m.fact, quality.TableChecks("fact_anime", non_empty=True))
    row = report.collect()[0]
    assert row.passed is False and row.rows == 0
    with pytest.raises(AssertionError, match=quality.NO_ROWS_MESSAGE):
        quality.assert_passed(report)


def test_entries_flatten_skips_null_inner_lists(spark):
    doc = variant(**{"data__MediaListCollection__lists": VALID["data"]["MediaListCollection"]["lists"]
                     + [{"name": "x", "status": "PLANNING", "entries": None}]})
    raw = landing.documents_from_text(text_frame(spark, doc))
    assert staging.explode_entries(staging.stage_media(raw)).count() == 1


def test_duplicate_entry_fails_unique(spark):
    lst = VALID["data"]["MediaListCollection"]["lists"][0]
    doc = variant(**{"data__MediaListCollection__lists": [lst, dict(lst, name="again")]})
    m = _models(spark, doc)
    report = quality.check_table(m.fact, quality.TableChecks("fact_anime", unique=["id"]))
    assert report.collect()[0].failures == 1


def test_snake_case():
    from shelfspark.functions import snake_case
    assert snake_case("averageScore") == "average_score"
    assert snake_case("siteURL") == "site_u_r_l"
    assert snake_case("id") == "id"


def test_latest_run_wins(spark):
    from pyspark.sql import functions as F
    lines = text_frame(spark, VALID)
    old = landing.documents_from_text(lines).withColumn("run_id", F.lit("2024-01-01"))
    changed = variant(**{entry_path("score"): 9})
    new = landing.documents_from_text(text_frame(spark, changed)).withColumn("run_id", F.lit("2024-02-01"))
    both = old.unionByName(new)
    assert Models(both).fact.count() == 2  # both runs read: duplicate entry ids
    latest = Models(both, latest_run_only=True).fact.collect()
    assert len(latest) == 1 and latest[0].score == 9.0


def test_chunked_documents_give_same_results(spark, small_models):
    """Users split over many bounded documents (as a very large list would be)."""
    from shelfspark.operators import scores
    from shelfspark.sources import fixtures
    docs = fixtures.build_documents(spark, "/root/testdata/sf0.001", max_entries=10)
    sizes = docs.selectExpr("size(flatten(data.MediaListCollection.lists.entries)) AS n")
    assert docs.count() > small_models.raw.count()
    assert sizes.agg({"n": "max"}).first()[0] <= 25  # hash chunks: bounded around max_entries
    chunked = Models(docs)
    assert chunked.fact.exceptAll(small_models.fact).count() == 0
    assert chunked.fact.count() == small_models.fact.count()
    assert chunked.users.count() == small_models.users.count()  # one row per user after dedupe
    assert (scores.count_scores_by_top(chunked.mart, "tag", 20).collect()
            == scores.count_scores_by_top(small_models.mart, "tag", 20).collect())
