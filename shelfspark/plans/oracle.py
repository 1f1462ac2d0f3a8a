"""DuckDB statements that state each catalog query as flat SQL on the driver tables.

They never see documents: entries, media and users are written directly from
``lineitem``/``orders``/``part``/``customer`` following the bridge rules, so
they check the whole Spark chain (nesting, staging, unnesting, joins).
Array columns are compared as ``|``-joined text on both sides.
"""

from __future__ import annotations

BRIDGE = """
agg AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS media_id,
         MAX(l.l_quantity) AS max_qty, COUNT(*) AS n_lines,
         MAX(o.o_orderstatus) AS max_status,
         MIN(o.o_orderdate) AS first_order, MAX(l.l_shipdate) AS last_ship
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey
),
entries AS (
  SELECT user_id * 4294967296 + media_id AS id, user_id, media_id,
         CAST(CAST(max_qty AS INTEGER) % 11 AS DOUBLE) AS score,
         n_lines AS progress,
         CASE max_status WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'CURRENT' ELSE 'PLANNING' END AS watch_status,
         CASE WHEN (user_id * 4294967296 + media_id) % 10 = 0 THEN NULL ELSE CAST(first_order AS DATE) END AS started_at,
         CASE WHEN max_status = 'F' THEN CAST(last_ship AS DATE) ELSE NULL END AS completed_at
  FROM agg
),
all_media AS (
  SELECT p_partkey AS id,
         CASE WHEN p_size % 10 = 0 THEN CAST([] AS VARCHAR[])
              ELSE [p_type, split_part(p_name, ' ', 1)] END AS genres,
         p_name AS description,
         'cover/' || CAST(p_partkey AS VARCHAR) AS cover_image,
         'ANIME' AS type,
         CASE WHEN p_size % 10 = 0 THEN CAST([] AS VARCHAR[])
              ELSE [split_part(p_name, ' ', 2), p_brand, 'size_' || CAST(p_size % 5 AS VARCHAR)] END AS tag_names,
         CAST(p_size AS BIGINT) AS tag_rank,
         CAST(CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size END AS BIGINT) AS episodes,
         p_type AS format,
         CASE p_size % 4 WHEN 0 THEN 'WINTER' WHEN 1 THEN 'SPRING' WHEN 2 THEN 'SUMMER' ELSE 'FALL' END AS season,
         CAST(2000 + p_size % 25 AS BIGINT) AS season_year,
         make_date(CAST(2000 + p_size % 25 AS BIGINT), CAST(1 + p_size % 12 AS BIGINT), CAST(1 + p_size % 28 AS BIGINT)) AS start_date,
         CAST(NULL AS DATE) AS end_date,
         CASE WHEN p_size % 2 = 0 AND p_size % 10 <> 0 THEN [p_name] ELSE CAST([] AS VARCHAR[]) END AS synonyms,
         p_name AS english_title,
         CASE WHEN p_size % 7 = 0 THEN NULL ELSE upper(p_name) END AS native_title,
         p_brand || ' ' || p_name AS romaji_title,
         'ORIGINAL' AS source,
         CAST(NULL AS VARCHAR) AS banner_image,
         'media/' || CAST(p_partkey AS VARCHAR) AS site_url,
         'FINISHED' AS status,
         CAST(p_size + 40 AS DOUBLE) / 10.0 AS average_score,
         CAST(p_size + 38 AS DOUBLE) / 10.0 AS mean_score,
         p_partkey % 1000 AS popularity,
         p_partkey % 10 AS trending,
         p_partkey % 100 AS favourites
  FROM part
),
dim_media AS (
  SELECT * FROM all_media WHERE id IN (SELECT media_id FROM entries)
),
dim_user AS (
  SELECT c_custkey AS id, c_name AS name,
         'img/' || CAST(c_custkey AS VARCHAR) AS avatar,
         c_mktsegment AS banner_image,
         'user/' || CAST(c_custkey AS VARCHAR) AS site_url,
         CAST(json_object('nation', c_nationkey) AS VARCHAR) AS statistics
  FROM customer WHERE c_custkey IN (SELECT user_id FROM entries)
),
fact AS (
  SELECT e.id, e.user_id, e.media_id, m.average_score, m.mean_score,
         m.popularity, m.trending, m.favourites, e.progress, m.episodes,
         e.score, e.watch_status, e.started_at, e.completed_at,
         '{}' AS stats, '[]' AS rankings
  FROM entries e JOIN all_media m ON e.media_id = m.id
),
media_unnested AS (
  SELECT id, english_title, native_title, romaji_title, description,
         UNNEST(synonyms) AS synonym, UNNEST(genres) AS genre, UNNEST(tag_names) AS tag,
         source, episodes, season, season_year, start_date, end_date, status
  FROM dim_media
),
mart AS (
  SELECT u.id AS user_id, u.name AS user_name, m.id AS media_id,
         m.english_title, m.native_title, m.romaji_title, m.description,
         m.synonym, m.genre, m.tag, m.source, m.episodes, m.season, m.season_year,
         m.start_date, m.end_date, m.status,
         f.progress, f.watch_status, f.score, f.average_score, f.mean_score,
         f.popularity, f.trending, f.favourites
  FROM fact f
  JOIN dim_user u ON f.user_id = u.id
  JOIN media_unnested m ON f.media_id = m.id
)
"""


def with_bridge(body: str) -> str:
    return "WITH " + BRIDGE.strip() + "\n" + body.strip()


def top_items(item: str, k: int) -> str:
    return with_bridge(f"""
SELECT {item}, score, count, CAST(rank AS BIGINT) AS rank FROM (
  SELECT {item}, score, count,
         ROW_NUMBER() OVER (PARTITION BY score ORDER BY count DESC, {item} ASC) AS rank
  FROM (SELECT {item}, score, COUNT(*) AS count FROM mart
        WHERE {item} IS NOT NULL AND score > 0.0 GROUP BY {item}, score) c
) r WHERE rank <= {k}
""")


COUNT_SCORES = with_bridge("""
SELECT score, COUNT(DISTINCT media_id) AS count FROM mart
WHERE score > 0.0 GROUP BY score ORDER BY count DESC, score DESC
""")

def _checks(rows: list[tuple[str, str, str | None, str, str]]) -> str:
    """Quality-report rows: (model, check, column, relation, failures expression)."""
    parts = []
    for model, check, column, rel, failures in rows:
        col = "NULL" if column is None else f"'{column}'"
        parts.append(f"SELECT '{model}' AS model, '{check}' AS check_name, CAST({col} AS VARCHAR) AS column_name, "
                     f"CAST({failures} AS BIGINT) AS failures, CAST(COUNT(*) AS BIGINT) AS rows, "
                     f"({failures}) = 0 AS passed FROM {rel}")
    return with_bridge("\nUNION ALL\n".join(parts))


QUALITY_REPORT = _checks([
    ("stg_media", "not_null", "data", "dim_user", "0"),
    ("stg_user", "not_null", "data", "dim_user", "0"),
    ("fact_anime", "non_empty", None, "fact", "CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END"),
    ("fact_anime", "not_null", "id", "fact", "COUNT(*) - COUNT(id)"),
    ("fact_anime", "not_null", "user_id", "fact", "COUNT(*) - COUNT(user_id)"),
    ("fact_anime", "not_null", "media_id", "fact", "COUNT(*) - COUNT(media_id)"),
    ("fact_anime", "unique", "id", "fact", "COUNT(id) - COUNT(DISTINCT id)"),
    ("dimension_user", "non_empty", None, "dim_user", "CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END"),
    ("dimension_user", "not_null", "id", "dim_user", "COUNT(*) - COUNT(id)"),
    ("dimension_user", "not_null", "name", "dim_user", "COUNT(*) - COUNT(name)"),
    ("dimension_user", "unique", "id", "dim_user", "COUNT(id) - COUNT(DISTINCT id)"),
    ("dimension_media", "non_empty", None, "dim_media", "CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END"),
    ("dimension_media", "not_null", "id", "dim_media", "COUNT(*) - COUNT(id)"),
    ("dimension_media", "unique", "id", "dim_media", "COUNT(id) - COUNT(DISTINCT id)"),
    ("anime_scores", "non_empty", None, "mart", "CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END"),
    ("anime_scores", "not_null", "user_id", "mart", "COUNT(*) - COUNT(user_id)"),
    ("anime_scores", "not_null", "media_id", "mart", "COUNT(*) - COUNT(media_id)"),
])

# Dirty-rule rows (entry id % 97): 1 fractional score, 2 missing progress, 4 impossible date.
FLAT_MEDIA_SELECT = """
SELECT id, array_to_string(genres, '|') AS genres, description, cover_image, type,
       array_to_string(list_transform(tag_names, lambda t: 'item:' || t || ':' || CAST(tag_rank AS VARCHAR)), '|') AS tags,
       episodes, format, season, season_year, {start_date} AS start_date, {end_date} AS end_date,
       array_to_string(synonyms, '|') AS synonyms,
       english_title AS title_english, native_title AS title_native, romaji_title AS title_romaji,
       source, banner_image, site_url, status
FROM {relation}
"""

TAG_GENRE_PAIRS = """
pairs AS (
  SELECT DISTINCT t.media_id, t.score, t.tag, g.genre
  FROM (SELECT media_id, score, tag FROM mart WHERE tag IS NOT NULL) t
  JOIN (SELECT media_id, score, genre FROM mart WHERE genre IS NOT NULL) g
  USING (media_id, score)
)
"""

# One over the sample deviation of each category's 0/1 column; the last index has no column.
INDEXED = "WITH " + BRIDGE.strip() + ",\n" + TAG_GENRE_PAIRS.strip() + """,
counts AS (SELECT {category} AS value, COUNT(*) AS c FROM pairs GROUP BY {category}),
ranked AS (
  SELECT value, c, ROW_NUMBER() OVER (ORDER BY c DESC, value ASC) - 1 AS idx, SUM(c) OVER () AS n,
         COUNT(*) OVER () AS k
  FROM counts),
indexed AS (
  SELECT value, CAST(idx AS BIGINT) AS idx, k,
         CASE WHEN idx < k - 1 THEN 1 / SQRT((c - CAST(c AS DOUBLE) * c / n) / (n - 1)) END AS scale
  FROM ranked)
"""
SCALE = INDEXED + "SELECT value, idx, ROUND(scale, 6) AS scale FROM indexed"

ANIME_SCORES_WIDE = with_bridge("""
SELECT f.media_id, f.user_id, f.progress, f.watch_status, f.score, f.average_score,
       f.mean_score, f.popularity, f.trending, f.favourites,
       u.id AS id, u.name AS name, m.id AS id_1, m.english_title, m.native_title,
       m.romaji_title, m.description, m.synonym, m.genre, m.tag, m.source, m.episodes,
       m.season, m.season_year, m.start_date, m.end_date, m.status
FROM fact f JOIN dim_user u ON f.user_id = u.id JOIN media_unnested m ON f.media_id = m.id
""")

TOPIC_COUNTS = with_bridge("""
SELECT 'raw_user' AS topic, COUNT(DISTINCT user_id) AS events FROM entries
UNION ALL
SELECT 'raw_media' AS topic, COUNT(*) AS events FROM entries
""")

STATEMENTS: dict[str, str] = {
    "fact_anime": with_bridge("SELECT * FROM fact"),
    "dimension_media": with_bridge(FLAT_MEDIA_SELECT.format(
        start_date="start_date", end_date="end_date", relation="dim_media")),
    "dimension_media_fanout": with_bridge(FLAT_MEDIA_SELECT.format(
        start_date="start_date", end_date="end_date",
        relation="(SELECT m.* FROM entries e JOIN all_media m ON e.media_id = m.id) v")),
    "dimension_user": with_bridge("SELECT * FROM dim_user"),
    "media_unnested": with_bridge("SELECT * FROM media_unnested"),
    "anime_scores": with_bridge("SELECT * FROM mart"),
    "anime_scores_wide": ANIME_SCORES_WIDE,
    "count_scores": COUNT_SCORES,
    "count_scores_df": COUNT_SCORES,
    "count_scores_sql": COUNT_SCORES,
    "count_scores_mart": COUNT_SCORES,
    "count_scores_by_top_genre": top_items("genre", 10),
    "count_scores_by_top_tag": top_items("tag", 20),
    "count_scores_by_top_genre_mart": top_items("genre", 10),
    "count_scores_by_top_tag_sql": top_items("tag", 20),
    "score_count_total": with_bridge("""
SELECT CAST(SUM(count) AS BIGINT) AS total FROM (
  SELECT score, COUNT(DISTINCT media_id) AS count FROM mart WHERE score > 0.0 GROUP BY score) s
"""),
    "mart_parquet_roundtrip": with_bridge("SELECT * FROM mart"),
    "raw_document_check": with_bridge("""
SELECT user_id, COUNT(DISTINCT watch_status) AS n_lists,
       COUNT(*) AS n_entries, true AS passed
FROM entries GROUP BY user_id
"""),
    "raw_json_roundtrip": COUNT_SCORES,
    "fact_anime_validated": with_bridge("""
SELECT id, user_id, media_id, average_score, mean_score, popularity, trending, favourites,
       CASE WHEN id % 97 = 3 THEN NULL ELSE progress END AS progress, episodes, score, watch_status,
       CASE WHEN id % 97 = 5 THEN NULL ELSE strftime(started_at, '%Y-%m-%d') END AS started_at,
       strftime(completed_at, '%Y-%m-%d') AS completed_at, stats, rankings
FROM fact WHERE id % 97 NOT IN (1, 2, 4)
"""),
    "dimension_media_validated": with_bridge(FLAT_MEDIA_SELECT.format(
        start_date="strftime(start_date, '%Y-%m-%d')", end_date="CAST(NULL AS VARCHAR)",
        relation="(SELECT * FROM all_media WHERE id IN (SELECT media_id FROM entries WHERE id % 97 <> 4)) v")),
    "dimension_user_validated": with_bridge("SELECT * FROM dim_user"),
    "quarantined_entries": with_bridge("""
SELECT 'fact_anime' AS model,
       CASE id % 97 WHEN 1 THEN 'score:not_int' WHEN 2 THEN 'progress:missing'
            ELSE 'startedAt:invalid_date' END AS reason,
       COUNT(*) AS rows
FROM entries WHERE id % 97 IN (1, 2, 4) GROUP BY 2
UNION ALL
SELECT 'dimension_media' AS model, 'startedAt:invalid_date' AS reason, COUNT(*) AS rows
FROM entries WHERE id % 97 = 4
"""),
    "fact_anime_sql_dirty": with_bridge("""
SELECT id, user_id, media_id, average_score, mean_score, popularity, trending, favourites,
       CASE WHEN id % 97 IN (2, 3) THEN NULL ELSE progress END AS progress, episodes,
       CASE WHEN id % 97 = 1 THEN score + 0.5 ELSE score END AS score, watch_status,
       CASE WHEN id % 97 IN (4, 5) THEN NULL ELSE started_at END AS started_at,
       completed_at, stats, rankings
FROM fact
"""),
    "fact_anime_sql_typed": with_bridge("""
SELECT id, user_id, media_id, average_score, mean_score, popularity, trending, favourites,
       CASE WHEN id % 97 IN (2, 3) THEN NULL ELSE progress END AS progress, episodes,
       CASE WHEN id % 97 = 1 THEN score + 0.5 ELSE score END AS score, watch_status,
       CASE WHEN id % 97 IN (4, 5) THEN NULL ELSE started_at END AS started_at,
       completed_at, stats, rankings
FROM fact
"""),
    "cast_faults": with_bridge("""
SELECT '$.data.MediaListCollection.lists[*].entries[*].' ||
       CASE id % 97 WHEN 8 THEN 'score' WHEN 9 THEN 'progress' ELSE 'media.episodes' END AS path,
       COUNT(*) AS n
FROM entries WHERE id % 97 IN (8, 9, 10) GROUP BY 1
"""),
    "media_cover_sql_dirty": with_bridge("""
SELECT id AS entry_id, media_id,
       CASE WHEN id % 97 = 7 THEN NULL ELSE 'cover/' || CAST(media_id AS VARCHAR) END AS cover_image
FROM entries
"""),
    "anime_scores_wide_validated": with_bridge("""
SELECT f.media_id, f.user_id, CASE WHEN f.id % 97 = 3 THEN NULL ELSE f.progress END AS progress,
       f.watch_status, f.score, f.average_score, f.mean_score, f.popularity, f.trending, f.favourites,
       u.id AS id, u.name AS name, m.id AS id_1, m.english_title, m.native_title, m.romaji_title,
       m.description, m.synonym, m.genre, m.tag, m.source, m.episodes, m.season, m.season_year,
       strftime(m.start_date, '%Y-%m-%d') AS start_date, CAST(NULL AS VARCHAR) AS end_date, m.status
FROM fact f
JOIN dim_user u ON f.user_id = u.id
JOIN media_unnested m ON f.media_id = m.id
WHERE f.id % 97 NOT IN (1, 2, 4)
"""),
    "quarantined_documents": with_bridge("""
SELECT DISTINCT user_id, CASE user_id % 23 WHEN 1 THEN 'unparsable' WHEN 2 THEN 'no_user' ELSE 'structure' END AS reason
FROM entries WHERE user_id % 23 IN (1, 2, 3)
"""),
    "envelope_faults": with_bridge("""
SELECT CASE WHEN user_id % 23 NOT IN (1, 2) THEN user_id END AS user_id,
       COUNT(DISTINCT CASE user_id % 23 WHEN 1 THEN NULL WHEN 4 THEN 'unnamed' ELSE watch_status END) AS n_lists,
       COUNT(*) FILTER (WHERE user_id % 23 <> 1) AS n_entries,
       BOOL_AND(user_id % 23 NOT IN (1, 2, 4)) AS passed
FROM entries GROUP BY 1
"""),
    "saved_mart_view": ANIME_SCORES_WIDE,
    "fact_preview": with_bridge("SELECT * EXCLUDE (stats, rankings) FROM fact ORDER BY id DESC LIMIT 5"),
    "user_preview": with_bridge("SELECT * EXCLUDE (statistics) FROM dim_user ORDER BY id DESC LIMIT 5"),
    "media_preview": with_bridge("""
SELECT id, description, cover_image, type, episodes, format, season, season_year, start_date, end_date,
       english_title AS english, native_title AS native, romaji_title AS romaji,
       source, banner_image, site_url, status
FROM dim_media ORDER BY id DESC LIMIT 5
"""),
    "gate_outcomes": with_bridge("""
SELECT 'standard' AS gate, true AS passed, CAST(NULL AS VARCHAR) AS message
UNION ALL
SELECT 'keys', true, NULL
UNION ALL
SELECT 'broken', false, 'no rows processed'
       || '; emptied.id not_null: ' || COUNT(*) FILTER (WHERE id % 97 = 3) || ' failing of ' || COUNT(*)
       || '; repeated.id unique: ' || COUNT(*) FILTER (WHERE id % 97 <> 3) || ' failing of ' || 2 * COUNT(*)
       || '; counted.* row_count: ' || ((SELECT COUNT(*) FROM dim_user) - 1) || ' failing of ' || (SELECT COUNT(*) FROM dim_user)
       || '; none.* non_empty: 1 failing of 0'
FROM fact
"""),
    "topic_event_fields": with_bridge("""
SELECT 'raw_user' AS topic, id, CAST(NULL AS BIGINT) AS user_id, CAST(NULL AS BIGINT) AS media_id, name, avatar AS image,
       site_url, CAST(NULL AS VARCHAR) AS watch_status, CAST(NULL AS DOUBLE) AS score, CAST(NULL AS BIGINT) AS progress,
       CAST(NULL AS BIGINT) AS episodes, CAST(NULL AS VARCHAR) AS genres, CAST(NULL AS VARCHAR) AS synonyms,
       CAST(NULL AS DATE) AS started_at, CAST(NULL AS DATE) AS completed_at
FROM dim_user
UNION ALL
SELECT 'raw_media', e.id, e.user_id, e.media_id, m.romaji_title, m.cover_image, m.site_url, e.watch_status, e.score,
       e.progress, m.episodes, array_to_string(m.genres, '|'), array_to_string(m.synonyms, '|'),
       e.started_at, e.completed_at
FROM entries e JOIN all_media m ON e.media_id = m.id
"""),
    "quality_report": QUALITY_REPORT,
    "tag_genre_pairs": "WITH " + BRIDGE.strip() + ",\n" + TAG_GENRE_PAIRS.strip() + "\nSELECT * FROM pairs",
    "category_index": "WITH " + BRIDGE.strip() + ",\n" + TAG_GENRE_PAIRS.strip() + """,
counts AS (
  SELECT 'tag' AS column_name, tag AS value, COUNT(*) AS count FROM pairs GROUP BY tag
  UNION ALL
  SELECT 'genre' AS column_name, genre AS value, COUNT(*) AS count FROM pairs GROUP BY genre
)
SELECT column_name, value, count,
       CAST(ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY count DESC, value ASC) - 1 AS BIGINT) AS idx
FROM counts""",
    "genre_scale": SCALE.replace("{category}", "genre"),
    "tag_scale": SCALE.replace("{category}", "tag"),
    "kmeans_invariants": "WITH " + BRIDGE.strip() + ",\n" + TAG_GENRE_PAIRS.strip() + """
SELECT COUNT(*) AS rows, true AS nearest, true AS cost_is_sum, true AS half_explained,
       true AS silhouette_in_range FROM pairs""",
    # Every scaled column has deviation 1, so the cost around the mean is (n - 1) x columns.
    "kmeans_cost_checks": "WITH " + BRIDGE.strip() + ",\n" + TAG_GENRE_PAIRS.strip() + """
SELECT CAST(k AS BIGINT) AS cluster, n AS rows, ROUND(CAST((n - 1) * g AS DOUBLE), 2) AS total,
       true AS cost_is_sum, true AS at_most_total
FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT genre) AS g FROM pairs) s, range(2, 100) r(k)""",
    "scaled_features": INDEXED.replace("{category}", "genre") + """
SELECT p.media_id, p.score, p.tag, p.genre,
       printf('%.6f', p.score / s.dev) || list_reduce(list_prepend('', list_transform(range(i.k - 1),
         lambda j: '|' || CASE WHEN j = i.idx THEN printf('%.6f', i.scale) ELSE '0.000000' END)),
         lambda a, b: a || b) AS standardized
FROM pairs p JOIN indexed i ON p.genre = i.value, (SELECT STDDEV_SAMP(score) AS dev FROM pairs) s""",
    "quality_failures": with_bridge("""
SELECT 'emptied' AS model, 'not_null' AS check_name, 'id' AS column_name,
       COUNT(*) FILTER (WHERE id % 97 = 3) AS failures, COUNT(*) AS rows, false AS passed FROM fact
UNION ALL
SELECT 'repeated', 'unique', 'id', COUNT(*) FILTER (WHERE id % 97 <> 3), 2 * COUNT(*), false FROM fact
UNION ALL
SELECT 'counted', 'row_count', NULL, COUNT(*) - 1, COUNT(*), false FROM dim_user
UNION ALL
SELECT 'none', 'non_empty', NULL, 1, 0, false
"""),
    "topic_event_ids": with_bridge("""
SELECT 'raw_user' AS topic, id FROM dim_user
UNION ALL
SELECT 'raw_media' AS topic, id FROM entries
"""),
    "topic_counts": TOPIC_COUNTS,
    "topic_stream_counts": TOPIC_COUNTS,
    "topic_replay": with_bridge("""
SELECT 'raw_user' AS topic, COUNT(DISTINCT user_id) AS events, COUNT(DISTINCT user_id) AS decoded FROM entries
UNION ALL
SELECT 'raw_media' AS topic, COUNT(*) AS events, COUNT(*) AS decoded FROM entries
"""),
}
