"""Query catalog: name -> ``(spark, sf_dir) -> DataFrame``.

Every query starts from the driver tables of ``sf_dir`` (or a landed raw
table derived from them, see ``plans.models.raw_documents``) and runs over
all of their rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import features, quality, scores, validate
from ..session import scratch_path, shuffles_for
from ..sources import fixtures, landing
from ..sources import parquet as parquet_io
from ..streaming import topics
from .models import Models, ValidatedModels, raw_documents, raw_table_reader

Query = Callable[[SparkSession, str], DataFrame]


def _models(spark: SparkSession, sf_dir: str) -> Models:
    return Models.for_tables(spark, sf_dir)


def flat_media(media: DataFrame) -> DataFrame:
    """Media dimension with arrays as ``|``-joined text (for engine-neutral comparison)."""
    tag_text = F.transform(F.col("tags"), lambda t: F.concat_ws(":", t["category"], t["name"], t["rank"].cast("string")))
    return media.select(
        "id", F.array_join("genres", "|").alias("genres"), "description", "cover_image", "type",
        F.array_join(tag_text, "|").alias("tags"), "episodes", "format", "season", "season_year",
        "start_date", "end_date", F.array_join("synonyms", "|").alias("synonyms"),
        F.col("title.english").alias("title_english"), F.col("title.native").alias("title_native"),
        F.col("title.romaji").alias("title_romaji"),
        "source", "banner_image", "site_url", "status")


def q_fact_anime(spark, sf_dir):
    return _models(spark, sf_dir).fact


def q_dimension_media(spark, sf_dir):
    return flat_media(_models(spark, sf_dir).media)


def q_dimension_media_fanout(spark, sf_dir):
    """The media model without de-duplication: one row per entry, as the SQL model yields."""
    from ..operators.models import dimension_media
    return flat_media(dimension_media(_models(spark, sf_dir).entries, dedupe=False))


def q_dimension_user(spark, sf_dir):
    return _models(spark, sf_dir).users


def q_media_unnested(spark, sf_dir):
    from ..operators.mart import media_unnested
    return media_unnested(_models(spark, sf_dir).media)


def q_anime_scores(spark, sf_dir):
    return _models(spark, sf_dir).mart


def q_anime_scores_wide(spark, sf_dir):
    return _models(spark, sf_dir).mart_wide


def q_count_scores(spark, sf_dir):
    m = _models(spark, sf_dir)
    return scores.count_scores_from_facts(m.fact, m.users, m.media)


def q_count_scores_mart(spark, sf_dir):
    return scores.count_scores(_models(spark, sf_dir).mart)


def q_count_scores_df(spark, sf_dir):
    return scores.count_scores_post_filter(_models(spark, sf_dir).mart)


def q_count_scores_sql(spark, sf_dir):
    return scores.count_scores_sql(spark, _models(spark, sf_dir).mart)


def q_top_genre(spark, sf_dir):
    m = _models(spark, sf_dir)
    return scores.count_scores_by_top_from_facts(m.fact, m.users, m.media, "genre", scores.TOP_GENRES)


def q_top_tag(spark, sf_dir):
    m = _models(spark, sf_dir)
    return scores.count_scores_by_top_from_facts(m.fact, m.users, m.media, "tag", scores.TOP_TAGS)


def q_top_genre_mart(spark, sf_dir):
    return scores.count_scores_by_top(_models(spark, sf_dir).mart, "genre", scores.TOP_GENRES)


def q_top_tag_sql(spark, sf_dir):
    return scores.count_scores_by_top_sql(spark, _models(spark, sf_dir).mart, "tag", scores.TOP_TAGS)


def q_score_count_total(spark, sf_dir):
    return scores.score_count_total(q_count_scores(spark, sf_dir))


def q_mart_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, f"anime_scores-{uuid.uuid4().hex}.parquet")
    parquet_io.write_parquet(_models(spark, sf_dir).mart, path, compression="zstd")
    return parquet_io.read_parquet(spark, path)


# Landed JSON is written once per (session, folder, kind) and reused.
_LANDED: dict[tuple[str, str, str], str] = {}


def _landed(spark: SparkSession, sf_dir: str, kind: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind)
    if key not in _LANDED:
        root = scratch_path(spark, f"landed-{kind}-{uuid.uuid4().hex}")
        with shuffles_for(spark, fixtures.line_count(spark, sf_dir)):
            if kind == "clean":
                landing.land_json(raw_documents(spark, sf_dir), root)
            else:
                fixtures.land_text(_dirty_text(spark, sf_dir), root)
        _LANDED[key] = root
    return _LANDED[key]


def _dirty_text(spark, sf_dir, **faults):
    """The dirty documents as lines, from entry facts that are written once."""
    staged = scratch_path(spark, f"entry-facts-{uuid.uuid4().hex}")
    return fixtures.build_dirty_documents_text(spark, sf_dir, staging_path=staged, **faults)


def _dirty_entries(spark, sf_dir, keys=validate.RECORD_KEYS):
    root = _landed(spark, sf_dir, "dirty")
    docs = landing.read_landed_variant(spark, root)
    return docs, validate.record_entries_from_text(landing.read_landed_text(spark, root), keys)


def _validated_models(spark, sf_dir):
    root = _landed(spark, sf_dir, "dirty")
    return ValidatedModels(landing.read_landed_variant(spark, root), lines=landing.read_landed_text(spark, root))


def q_raw_document_check(spark, sf_dir):
    docs = landing.read_landed_variant(spark, _landed(spark, sf_dir, "clean"))
    return validate.user_envelope_check(validate.raw_envelope_check(docs))


def q_raw_document_size(spark, sf_dir):
    docs = landing.read_landed_variant(spark, _landed(spark, sf_dir, "clean"))
    return validate.raw_envelope_check(docs).select("doc_id", "n_bytes", "passed")


def q_raw_json_roundtrip(spark, sf_dir):
    """Landed JSON read back with the fixed schema, through the whole model chain.

    The lines are parsed once, into a raw table of which each model reads its own leaves.
    """
    docs = landing.read_landed(spark, _landed(spark, sf_dir, "clean"), run_id=fixtures.FIXTURE_RUN_ID)
    path = scratch_path(spark, f"raw-landed-{uuid.uuid4().hex}")
    landing.write_raw_table(docs, path, compression="zstd")
    m = Models(landing.read_raw_table(spark, path, fixtures.FIXTURE_RUN_ID))
    m.raw_reader = raw_table_reader(spark, path, fixtures.FIXTURE_RUN_ID)
    return scores.count_scores_from_facts(m.fact, m.users, m.media)


def q_fact_anime_validated(spark, sf_dir):
    _, ents = _dirty_entries(spark, sf_dir, validate.FACT_KEYS)
    return validate.validated_fact(ents)[0]


def q_dimension_media_validated(spark, sf_dir):
    return flat_media(_validated_models(spark, sf_dir).media)


def q_dimension_user_validated(spark, sf_dir):
    return _validated_models(spark, sf_dir).users


def q_fact_anime_sql_dirty(spark, sf_dir):
    """SQL mode on the dirty documents: every row kept, casts instead of checks."""
    _, ents = _dirty_entries(spark, sf_dir, validate.SQL_FACT_KEYS)
    return validate.sql_mode_fact(ents)


def q_fact_anime_sql_typed(spark, sf_dir):
    """The same documents through the build job's reader, of the fact's members, and the fact model."""
    docs = landing.read_landed(spark, _landed(spark, sf_dir, "dirty"), schema=schemas.FACT_RAW_SCHEMA)
    return Models(docs, strict_dates=False).fact


def q_cast_faults(spark, sf_dir):
    """Values that no cast takes, by path, in documents that hold some."""
    lines = _dirty_text(spark, sf_dir, faults=True)
    return landing.cast_faults(landing.documents_from_text(lines, faults=True, schema=schemas.NUMBERS_RAW_SCHEMA))


def q_media_cover_sql_dirty(spark, sf_dir):
    _, ents = _dirty_entries(spark, sf_dir, validate.COVER_KEYS)
    return validate.sql_mode_media_cover(ents)


def q_anime_scores_wide_validated(spark, sf_dir):
    """The 27-column wide mart over the validated tables (the validated path's end)."""
    return _validated_models(spark, sf_dir).mart_wide


def q_quarantined_entries(spark, sf_dir):
    return validate.quarantine_summary({
        "fact_anime": validate.validated_fact(_dirty_entries(spark, sf_dir, validate.FACT_KEYS)[1])[1],
        "dimension_media": validate.validated_media(_dirty_entries(spark, sf_dir, validate.MEDIA_KEYS)[1])[1],
    })


def q_quarantined_documents(spark, sf_dir):
    """Documents that give no rows, by user: lines cut short, no user, entries without media."""
    lines = _dirty_text(spark, sf_dir, document_faults=True)
    doc_id = F.regexp_extract("value", r'^\{"doc_id":(\d+)', 1).cast("long")
    return (validate.document_quarantine(lines)
            .select(F.shiftright(doc_id, fixtures.CHUNK_BITS).alias("user_id"), "reason").distinct())


def q_envelope_faults(spark, sf_dir):
    """The envelope check where it fails; documents without a readable user are one row."""
    lines = _dirty_text(spark, sf_dir, document_faults=True)
    return validate.user_envelope_check(validate.raw_envelope_check(landing.variant_documents_from_text(lines)))


def q_saved_mart_view(spark, sf_dir):
    """The three models as named tables and the mart as a view on them, read by name in another session."""
    m = _models(spark, sf_dir)
    schema = f"shelfspark_{uuid.uuid4().hex[:12]}"
    for name, df in (("fact_anime", m.fact), ("dimension_user", m.users), ("dimension_media", m.media)):
        landing.save_table(df, schema, name, scratch_path(spark, f"{schema}-{name}"))
    return spark.newSession().table(landing.create_mart_view(spark, schema))


def q_fact_preview(spark, sf_dir):
    return quality.preview(_models(spark, sf_dir).fact)


def q_user_preview(spark, sf_dir):
    return quality.preview(_models(spark, sf_dir).users)


def q_media_preview(spark, sf_dir):
    return quality.preview(_models(spark, sf_dir).media).select("*", "title.*").drop("title")


def q_gate_outcomes(spark, sf_dir):
    """``(gate, passed, message)``: the blocking gate over checks that hold and over checks that do not."""
    m = _models(spark, sf_dir)
    reports = {"standard": q_quality_report(spark, sf_dir), "broken": q_quality_failures(spark, sf_dir),
               "keys": quality.check_table(m.users, quality.TableChecks("dimension_user", unique=["id"]))}
    rows = []
    for gate, report in reports.items():  # a row per check reaches the gate
        try:
            quality.assert_passed(report)
            rows.append((gate, True, None))
        except AssertionError as err:
            rows.append((gate, False, str(err)))
    return spark.createDataFrame(rows, "gate string, passed boolean, message string")


def q_topic_event_fields(spark, sf_dir):
    """Every event decoded again, field by field."""
    d = topics.decode(topics.topic_events(raw_documents(spark, sf_dir)))

    def field(path, kind):
        return F.try_variant_get("decoded", path, kind)

    def date(name):
        y, month, day = (field(f"$.{name}.{p}", "int") for p in ("year", "month", "day"))
        return F.make_date(y, month, day)
    user = F.col("topic") == topics.RAW_USER_TOPIC
    return d.select(
        "topic", field("$.id", "bigint").alias("id"), field("$.userId", "bigint").alias("user_id"),
        field("$.mediaId", "bigint").alias("media_id"),
        F.when(user, field("$.name", "string")).otherwise(field("$.media.title.romaji", "string")).alias("name"),
        F.when(user, field("$.avatar.large", "string")).otherwise(
            field("$.media.coverImage.extraLarge", "string")).alias("image"),
        F.when(user, field("$.siteUrl", "string")).otherwise(field("$.media.siteUrl", "string")).alias("site_url"),
        field("$.status", "string").alias("watch_status"), field("$.score", "double").alias("score"),
        field("$.progress", "bigint").alias("progress"), field("$.media.episodes", "bigint").alias("episodes"),
        F.array_join(field("$.media.genres", "array<string>"), "|").alias("genres"),
        F.array_join(field("$.media.synonyms", "array<string>"), "|").alias("synonyms"),
        date("startedAt").alias("started_at"), date("completedAt").alias("completed_at"))


def q_quality_report(spark, sf_dir):
    return quality.quality_report(quality.standard_checks(_models(spark, sf_dir)))


def q_topic_events(spark, sf_dir):
    return topics.topic_events(raw_documents(spark, sf_dir))


def q_topic_event_ids(spark, sf_dir):
    """Events decoded back: (topic, id) from each JSON payload."""
    ev = topics.decode(topics.topic_events(raw_documents(spark, sf_dir)))
    return ev.select("topic", F.try_variant_get("decoded", "$.id", "bigint").alias("id"))


def q_topic_counts(spark, sf_dir):
    """Events per topic; payloads are not needed, so a known raw table is read narrowed."""
    from .. import schemas
    narrow = _models(spark, sf_dir)._narrow(schemas.EVENT_COUNT_RAW_SCHEMA)
    docs = raw_documents(spark, sf_dir) if narrow is None else narrow
    return topics.topic_counts(topics.topic_events(docs))


def q_topic_replay(spark, sf_dir):
    log = scratch_path(spark, f"topic-log-{uuid.uuid4().hex}")
    topics.write_topic_log(topics.topic_events(raw_documents(spark, sf_dir)), log)
    out = scratch_path(spark, f"topic-replay-{uuid.uuid4().hex}")
    delivered = topics.replay_topic_log(spark, log, out + "/data", out + "/checkpoint")
    return topics.replay_counts(delivered)


def q_topic_stream_counts(spark, sf_dir):
    """Landed documents fanned out as a stream, the events of its log counted."""
    log, checkpoint = (scratch_path(spark, f"topic-stream-{x}-{uuid.uuid4().hex}") for x in ("log", "checkpoint"))
    topics.stream_documents_to_topic_log(spark, _landed(spark, sf_dir, "clean"), log, checkpoint).awaitTermination()
    return topics.topic_counts(spark.read.format("text").load(log))


def q_tag_genre_pairs(spark, sf_dir):
    m = _models(spark, sf_dir)
    return features.tag_genre_pairs(m.fact, m.users, m.media)


def _stored_pairs(spark, sf_dir):
    """The rows written once: a fit and what is made of it read them several times, each time joining them anew."""
    path = scratch_path(spark, f"tag-genre-pairs-{uuid.uuid4().hex}")
    q_tag_genre_pairs(spark, sf_dir).write.parquet(path, compression="zstd")
    return spark.read.parquet(path)


def q_category_index(spark, sf_dir):
    indexed, _ = features.index_categories(_stored_pairs(spark, sf_dir))
    return features.category_index(indexed)


def _genre_points(spark, sf_dir, pairs=None):
    """The rows and their weighted points, which are few."""
    pairs = q_tag_genre_pairs(spark, sf_dir) if pairs is None else pairs
    return pairs, features.point_features(features.category_points(pairs).persist())


def q_scaled_features(spark, sf_dir):
    """Every row's vector as ``|``-joined text of six decimals."""
    pairs, points = _genre_points(spark, sf_dir, _stored_pairs(spark, sf_dir))
    entries = F.transform(vector_to_array("standardized"), lambda x: F.format_string("%.6f", x))
    return features.rows_of_points(
        pairs, points.withColumn("standardized", F.array_join(entries, "|")), ["standardized"]).select(
        "media_id", "score", "tag", "genre", "standardized")


def q_genre_scale(spark, sf_dir):
    return features.category_scale(features.pair_features(_stored_pairs(spark, sf_dir)), "genre")


def q_tag_scale(spark, sf_dir):
    """The same encoding, assembling and scaling for the tag."""
    return features.category_scale(features.pair_features(_stored_pairs(spark, sf_dir), "tag"), "tag")


def q_kmeans_invariants(spark, sf_dir):
    _, points = _genre_points(spark, sf_dir)
    return spark.createDataFrame(features.kmeans_invariants(points).toArrow())  # one row


def q_quality_failures(spark, sf_dir):
    """The checks on tables that break them: a key emptied, rows repeated, a row too many, no rows."""
    m = _models(spark, sf_dir)
    fact = m.fact.select(F.when(F.col("id") % 97 != 3, F.col("id")).alias("id"), "user_id")
    report = quality.quality_report([
        (fact, quality.TableChecks("emptied", not_null=["id", "user_id"], non_empty=True)),
        (fact.unionByName(fact), quality.TableChecks("repeated", unique=["id"])),
        (m.users, quality.TableChecks("counted", expected_rows=1)),
        (m.users.where("id < 0"), quality.TableChecks("none", non_empty=True)),
    ])
    return quality.failed_checks(report)


def q_kmeans_cost(spark, sf_dir):
    return features.kmeans_sweep(spark, _genre_points(spark, sf_dir)[1])


def q_kmeans_cost_checks(spark, sf_dir):
    """The sweep's costs recomputed from the written centres."""
    return features.sweep_checks(spark, _genre_points(spark, sf_dir)[1])


def q_kmeans_assign(spark, sf_dir):
    pairs, points = _genre_points(spark, sf_dir, _stored_pairs(spark, sf_dir))
    assigned = features.kmeans_assign(points).withColumn("prediction", F.col("prediction").cast("long"))
    return features.rows_of_points(pairs, assigned, ["prediction"]).select(
        "media_id", "score", "tag", "genre", "prediction")


def q_cluster_profile(spark, sf_dir):
    return features.cluster_profile(features.kmeans_assign(_genre_points(spark, sf_dir)[1]))


def q_kmeans_summary(spark, sf_dir):
    _, points = _genre_points(spark, sf_dir)
    model = features.kmeans_fit(points, features.CHOSEN_K)
    sil = features.silhouette(model.transform(points))
    cost = float(model.summary.trainingCost)
    return spark.createDataFrame([(features.CHOSEN_K, cost, float(sil))], "k long, cost double, silhouette double")


QUERIES: dict[str, Query] = {
    "fact_anime": q_fact_anime,
    "dimension_media": q_dimension_media,
    "dimension_media_fanout": q_dimension_media_fanout,
    "dimension_user": q_dimension_user,
    "media_unnested": q_media_unnested,
    "anime_scores": q_anime_scores,
    "anime_scores_wide": q_anime_scores_wide,
    "count_scores": q_count_scores,
    "count_scores_mart": q_count_scores_mart,
    "count_scores_df": q_count_scores_df,
    "count_scores_sql": q_count_scores_sql,
    "count_scores_by_top_genre": q_top_genre,
    "count_scores_by_top_tag": q_top_tag,
    "count_scores_by_top_genre_mart": q_top_genre_mart,
    "count_scores_by_top_tag_sql": q_top_tag_sql,
    "score_count_total": q_score_count_total,
    "mart_parquet_roundtrip": q_mart_parquet_roundtrip,
    "raw_document_check": q_raw_document_check,
    "raw_document_size": q_raw_document_size,
    "raw_json_roundtrip": q_raw_json_roundtrip,
    "fact_anime_validated": q_fact_anime_validated,
    "dimension_media_validated": q_dimension_media_validated,
    "dimension_user_validated": q_dimension_user_validated,
    "quarantined_entries": q_quarantined_entries,
    "anime_scores_wide_validated": q_anime_scores_wide_validated,
    "fact_anime_sql_dirty": q_fact_anime_sql_dirty,
    "fact_anime_sql_typed": q_fact_anime_sql_typed,
    "cast_faults": q_cast_faults,
    "media_cover_sql_dirty": q_media_cover_sql_dirty,
    "quarantined_documents": q_quarantined_documents,
    "envelope_faults": q_envelope_faults,
    "saved_mart_view": q_saved_mart_view,
    "fact_preview": q_fact_preview,
    "user_preview": q_user_preview,
    "media_preview": q_media_preview,
    "gate_outcomes": q_gate_outcomes,
    "topic_event_fields": q_topic_event_fields,
    "quality_report": q_quality_report,
    "topic_events": q_topic_events,
    "topic_event_ids": q_topic_event_ids,
    "topic_counts": q_topic_counts,
    "topic_replay": q_topic_replay,
    "topic_stream_counts": q_topic_stream_counts,
    "tag_genre_pairs": q_tag_genre_pairs,
    "category_index": q_category_index,
    "scaled_features": q_scaled_features,
    "kmeans_assign": q_kmeans_assign,
    "cluster_profile": q_cluster_profile,
    "kmeans_summary": q_kmeans_summary,
    "genre_scale": q_genre_scale,
    "tag_scale": q_tag_scale,
    "kmeans_invariants": q_kmeans_invariants,
    "quality_failures": q_quality_failures,
    "kmeans_cost": q_kmeans_cost,
    "kmeans_cost_checks": q_kmeans_cost_checks,
}
