"""The wide ``anime_scores`` mart: fact x user x lockstep-unnested media."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lockstep_unnest
from ..schemas import MART_COLUMNS

# The mart's fact-side and media-side column lists, in order.
STATS_COLUMNS = ["media_id", "user_id", "progress", "watch_status", "score",
                 "average_score", "mean_score", "popularity", "trending", "favourites"]

MEDIA_UNNESTED_COLUMNS = ["id", "english_title", "native_title", "romaji_title", "description",
                          "synonym", "genre", "tag", "source", "episodes", "season",
                          "season_year", "start_date", "end_date", "status"]


def media_unnested(dim_media: DataFrame) -> DataFrame:
    """Media rows with ``synonyms``, ``genres`` and tag names unnested side by side.

    Row count per media = longest of the three arrays; all empty -> no rows.
    A generator over each row: narrow, no shuffle.
    """
    return dim_media.select(
        "id",
        F.col("title.english").alias("english_title"),
        F.col("title.native").alias("native_title"),
        F.col("title.romaji").alias("romaji_title"),
        "description",
        lockstep_unnest({
            "synonym": F.col("synonyms"),
            "genre": F.col("genres"),
            "tag": F.col("tags.name"),
        }),
        "source", "episodes", "season", "season_year", "start_date", "end_date", "status",
    )


def unnested_rows(dim_media: DataFrame) -> DataFrame:
    """``(id, n)``: how many rows ``media_unnested`` gives a media, 0 included."""
    lengths = [F.coalesce(F.size(c), F.lit(0)) for c in ("synonyms", "genres", "tags")]
    return dim_media.select("id", F.greatest(*lengths, F.lit(0)).cast("long").alias("n"))


def mart_keys(fact: DataFrame, users: DataFrame, dim_media: DataFrame) -> DataFrame:
    """``(user_id, media_id, n)``: a row stands for ``n`` rows of the mart.

    All mart rows are counted; ``user_id`` is one of the users of the media,
    and null in a row of its own if it is null in the mart. Keys only: the
    entries are summed a media before they meet the array lengths.
    """
    entries = (fact.select("user_id", "media_id").join(users.select("id"), F.col("user_id") == F.col("id"))
               .groupBy(F.col("id").isNull().alias("_missing"), "media_id")
               .agg(F.max("id").alias("user_id"), F.count(F.lit(1)).alias("entries")))
    lengths = unnested_rows(dim_media).where(F.col("n") > 0)
    return (entries.join(lengths, F.col("media_id") == lengths["id"])
            .select("user_id", lengths["id"].alias("media_id"), (F.col("entries") * F.col("n")).alias("n")))


def _joined(fact: DataFrame, users: DataFrame, dim_media: DataFrame):
    stats = fact.select(*STATS_COLUMNS).alias("stats")
    u = users.select("id", "name").alias("users")
    media = media_unnested(dim_media).alias("media")
    # Equi-joins without hints: AQE turns a join into a broadcast only when the
    # measured shuffle output of the dimension side is under the threshold,
    # and splits skewed partitions (a user or media holding many rows) otherwise.
    joined = (stats.join(u, F.col("stats.user_id") == F.col("users.id"))
              .join(media, F.col("stats.media_id") == F.col("media.id")))
    return joined


def anime_scores(fact: DataFrame, users: DataFrame, dim_media: DataFrame) -> DataFrame:
    """25-column mart (grain: entry x unnested media position)."""
    j = _joined(fact, users, dim_media)
    renames = {
        "user_id": "users.id", "user_name": "users.name", "media_id": "media.id",
    }
    stats_cols = {"progress", "watch_status", "score", "average_score", "mean_score",
                  "popularity", "trending", "favourites"}
    cols = []
    for c in MART_COLUMNS:
        if c in renames:
            cols.append(F.col(renames[c]).alias(c))
        elif c in stats_cols:
            cols.append(F.col(f"stats.{c}").alias(c))
        else:
            cols.append(F.col(f"media.{c}").alias(c))
    return j.select(*cols)


def anime_scores_wide(fact: DataFrame, users: DataFrame, dim_media: DataFrame) -> DataFrame:
    """27-column ``SELECT *`` form: stats, user ``id, name``, media (its id as ``id_1``)."""
    j = _joined(fact, users, dim_media)
    cols = [F.col(f"stats.{c}").alias(c) for c in STATS_COLUMNS]
    cols += [F.col("users.id").alias("id"), F.col("users.name").alias("name"),
             F.col("media.id").alias("id_1")]
    cols += [F.col(f"media.{c}").alias(c) for c in MEDIA_UNNESTED_COLUMNS[1:]]
    return j.select(*cols)
