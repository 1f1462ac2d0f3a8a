"""Score queries over the mart: distinct counts, per-group top-k, totals.

Two routes give the same answers:

* the *mart route* runs the query text on the wide mart (what a SQL user
  writes against the view);
* the *fact route* never builds the wide mart. Counting distinct media only
  needs to know that an entry joins a user and a media with at least one
  unnested row (left-semi joins), and a ``genre``/``tag`` count only needs one
  row per non-null array element, so entries are first pre-aggregated to
  ``(media_id, score) -> n`` (map-side combined, so a hot media or user is
  reduced before any shuffle) and only then joined with the exploded genres.
  Both routes assume dimension ids are unique, which the deduplicating
  dimension builders guarantee.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the reference's report queries.
TOP_GENRES = 10
TOP_TAGS = 20

# Fixed value: the distinct-media-per-score report as SQL text, run on a view.
COUNT_SCORES_SQL = (
    "SELECT score, COUNT(DISTINCT media_id) AS count FROM {view} "
    "WHERE score > 0.0 GROUP BY score ORDER BY count DESC, score DESC"
)

TOP_ITEMS_SQL = """
WITH counted AS (
  SELECT {item}, score, COUNT(*) AS count
  FROM {view}
  WHERE {item} IS NOT NULL AND score > 0.0
  GROUP BY {item}, score
),
ranked AS (
  SELECT {item}, score, count,
         ROW_NUMBER() OVER (PARTITION BY score ORDER BY count DESC, {item} ASC) AS rank
  FROM counted
)
SELECT {item}, score, count, CAST(rank AS BIGINT) AS rank
FROM ranked
WHERE rank <= {k}
ORDER BY count DESC, score DESC, {item} ASC
"""


# ---------------------------------------------------------------- mart route

def count_scores(mart: DataFrame) -> DataFrame:
    """Distinct media per score, scored entries only, most frequent first."""
    return (mart.where(F.col("score") > 0.0)
            .groupBy("score")
            .agg(F.count_distinct("media_id").alias("count"))
            .orderBy(F.desc("count"), F.desc("score")))


def count_scores_post_filter(mart: DataFrame) -> DataFrame:
    """Same query with the filter after the aggregate (Catalyst moves it below)."""
    aggs = mart.groupBy("score").agg(F.count_distinct("media_id").alias("count"))
    return aggs.filter(aggs["score"] > 0.0).orderBy(F.desc("count"), F.desc("score"))


def count_scores_sql(spark: SparkSession, mart: DataFrame, view: str = "anime_scores") -> DataFrame:
    """Same query as SQL text on a temp view of the mart."""
    mart.createOrReplaceTempView(view)
    return spark.sql(COUNT_SCORES_SQL.format(view=view))


def top_k_per_group(counts: DataFrame, group_col: str, item_col: str, k: int,
                    count_col: str = "count") -> DataFrame:
    """Keep the ``k`` largest ``count_col`` per ``group_col`` (ties by item, ascending).

    ``row_number() <= k`` is planned with a ``WindowGroupLimit`` that trims
    each partition to k rows per group before the window's shuffle.
    """
    w = Window.partitionBy(group_col).orderBy(F.desc(count_col), F.asc(item_col))
    return (counts.withColumn("rank", F.row_number().over(w).cast("long"))
            .where(F.col("rank") <= k)
            .orderBy(F.desc(count_col), F.desc(group_col), F.asc(item_col)))


def count_by_item_score(mart: DataFrame, item: str) -> DataFrame:
    """Mart rows per (item, score) for scored rows with a non-null item."""
    return (mart.where(F.col(item).isNotNull() & (F.col("score") > 0.0))
            .groupBy(item, "score").agg(F.count(F.lit(1)).alias("count")))


def count_scores_by_top(mart: DataFrame, item: str, k: int) -> DataFrame:
    return top_k_per_group(count_by_item_score(mart, item), "score", item, k)


def count_scores_by_top_sql(spark: SparkSession, mart: DataFrame, item: str, k: int,
                            view: str = "anime_scores") -> DataFrame:
    mart.createOrReplaceTempView(view)
    return spark.sql(TOP_ITEMS_SQL.format(item=item, k=k, view=view))


def score_count_total(count_scores_df: DataFrame) -> DataFrame:
    """Sum of the ``count`` column of a score-count result."""
    return count_scores_df.agg(F.sum("count").cast("long").alias("total"))


# ---------------------------------------------------------------- fact route

def _scored_entries(fact: DataFrame, users: DataFrame) -> DataFrame:
    scored = fact.where(F.col("score") > 0.0).select("user_id", "media_id", "score")
    return scored.join(users.select(F.col("id").alias("user_id")), "user_id", "left_semi")


def _fanned_media(dim_media: DataFrame) -> DataFrame:
    """Media ids that produce at least one mart row."""
    n = F.greatest(F.size(F.coalesce("synonyms", F.array())),
                   F.size(F.coalesce("genres", F.array())),
                   F.size(F.coalesce("tags", F.array())))
    return dim_media.where(n > 0).select(F.col("id").alias("media_id"))


def count_scores_from_facts(fact: DataFrame, users: DataFrame, dim_media: DataFrame) -> DataFrame:
    """``count_scores`` without materialising the mart."""
    pairs = _scored_entries(fact, users).select("media_id", "score").distinct()
    return (pairs.join(_fanned_media(dim_media), "media_id", "left_semi")
            .groupBy("score").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.desc("score")))


def _items(dim_media: DataFrame, item: str) -> DataFrame:
    if item == "genre":
        arr = F.col("genres")
    elif item == "tag":
        arr = F.col("tags.name")
    elif item == "synonym":
        arr = F.col("synonyms")
    else:
        raise ValueError(f"unknown item column {item!r}")
    return (dim_media.select(F.col("id").alias("media_id"), F.explode(arr).alias(item))
            .where(F.col(item).isNotNull()))


def count_by_item_score_from_facts(fact: DataFrame, users: DataFrame, dim_media: DataFrame,
                                   item: str) -> DataFrame:
    per_media = (_scored_entries(fact, users)
                 .groupBy("media_id", "score").agg(F.count(F.lit(1)).alias("n")))
    return (per_media.join(_items(dim_media, item), "media_id")
            .groupBy(item, "score").agg(F.sum("n").cast("long").alias("count")))


def count_scores_by_top_from_facts(fact: DataFrame, users: DataFrame, dim_media: DataFrame,
                                   item: str, k: int) -> DataFrame:
    return top_k_per_group(count_by_item_score_from_facts(fact, users, dim_media, item),
                           "score", item, k)
