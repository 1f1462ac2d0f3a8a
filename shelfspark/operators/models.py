"""Fact and dimension models (SQL mode): path + cast projections of entries/users.

The validated mode lives in ``operators.validate``; both share these column
names and types, except that the validated mode keeps dates as ISO text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_from_parts

# Fixed value: media scores arrive on a 0-100 scale and are stored on 0-10.
MEDIA_SCORE_DIVISOR = 10.0


def fact_anime(entries: DataFrame, strict_dates: bool = True) -> DataFrame:
    """16-column fact table, one row per list entry (grain: entry)."""
    e, m = F.col("entry"), F.col("entry.media")
    return entries.select(
        e["id"].cast("long").alias("id"),
        e["userId"].cast("long").alias("user_id"),
        m["id"].cast("long").alias("media_id"),
        (m["averageScore"].cast("double") / F.lit(MEDIA_SCORE_DIVISOR)).alias("average_score"),
        (m["meanScore"].cast("double") / F.lit(MEDIA_SCORE_DIVISOR)).alias("mean_score"),
        m["popularity"].cast("long").alias("popularity"),
        m["trending"].cast("long").alias("trending"),
        m["favourites"].cast("long").alias("favourites"),
        e["progress"].cast("long").alias("progress"),
        m["episodes"].cast("long").alias("episodes"),
        e["score"].cast("double").alias("score"),
        e["status"].alias("watch_status"),
        date_from_parts(e["startedAt"], strict_dates).alias("started_at"),
        date_from_parts(e["completedAt"], strict_dates).alias("completed_at"),
        m["stats"].alias("stats"),
        m["rankings"].alias("rankings"),
    )


def dimension_media_rows(entries: DataFrame, strict_dates: bool = True) -> DataFrame:
    """18-column media dimension, one row per entry (the raw fan-out)."""
    m = F.col("entry.media")
    keys = [c for c in ("run_id", "doc_id") if c in entries.columns]
    return entries.select(
        *keys,
        F.col("entry.id").alias("entry_id"),
        m["id"].cast("long").alias("id"),
        m["genres"].alias("genres"),
        m["description"].alias("description"),
        m["coverImage"]["extraLarge"].alias("cover_image"),
        m["type"].alias("type"),
        m["tags"].alias("tags"),
        m["episodes"].cast("long").alias("episodes"),
        m["format"].alias("format"),
        m["season"].alias("season"),
        m["seasonYear"].cast("long").alias("season_year"),
        date_from_parts(m["startDate"], strict_dates).alias("start_date"),
        date_from_parts(m["endDate"], strict_dates).alias("end_date"),
        m["synonyms"].alias("synonyms"),
        m["title"].alias("title"),
        m["source"].alias("source"),
        m["bannerImage"].alias("banner_image"),
        m["siteUrl"].alias("site_url"),
        m["status"].alias("status"),
    )


# Bits of the bitmap of winners: 16 MB at most when broadcast, whatever the number of keys.
WINNER_BITS = 1 << 27


def possible_winners(df: DataFrame, key: str, order_cols: list[str], keys: DataFrame | None = None) -> DataFrame:
    """The rows of ``df`` that may hold a key's greatest ``order_cols``: all that do, and few others.

    The winners are found on the key and order columns alone (``keys``: the same
    rows with these columns, if they can be read narrower) and their hashes set
    bits of a bitmap of fixed size, which is broadcast; so the wide rows neither
    move nor are sorted here.
    """
    def at(k, order):
        return F.pmod(F.xxhash64(k, *order), F.lit(WINNER_BITS))

    best = (df if keys is None else keys).groupBy(F.col(key).alias("_key")).agg(
        F.max(F.struct(*order_cols)).alias("_order"))
    won = at(F.col("_key"), [F.col("_order")[c] for c in order_cols])
    bitmaps = best.groupBy(F.bitmap_bucket_number(won).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(won)).alias("_bitmap"))
    own = at(F.col(key), [F.col(c) for c in order_cols])
    byte = F.expr("cast(conv(hex(substring(_bitmap, cast(_place div 8 as int) + 1, 1)), 16, 10) as int)")
    return (df.withColumn("_bucket", F.bitmap_bucket_number(own)).withColumn("_place", F.bitmap_bit_position(own))
            .join(F.broadcast(bitmaps), "_bucket")
            .where(byte.bitwiseAND(F.expr("shiftleft(1, cast(_place % 8 as int))")) != 0)
            .select(*df.columns))


def latest_per_key(df: DataFrame, key: str, order_cols: list[str], value_cols: list[str],
                   keys: DataFrame | None = None) -> DataFrame:
    """Keep one row per ``key``: the one with the greatest ``order_cols``.

    Most copies are set aside by ``possible_winners`` before a whole row moves;
    ``df`` is read twice for that (``keys``: see there). ``max_by`` is a
    declarative aggregate, so Spark combines the rest map-side.
    """
    order = F.struct(*order_cols)
    packed = F.struct(*[F.col(c) for c in value_cols])
    return (possible_winners(df, key, order_cols, keys).groupBy(key)
            .agg(F.max_by(packed, order).alias("_v"))
            .select(key, *[F.col("_v")[c].alias(c) for c in value_cols]))


def media_keys(entries: DataFrame) -> DataFrame:
    """``id`` of the media and the order of its copies, of entries that may be read with their ids only."""
    keys = [c for c in ("run_id", "doc_id") if c in entries.columns]
    return entries.select(*keys, F.col("entry.id").alias("entry_id"), F.col("entry.media.id").cast("long").alias("id"))


def dimension_media(entries: DataFrame, dedupe: bool = True, strict_dates: bool = True,
                    keys: DataFrame | None = None) -> DataFrame:
    """Media dimension. With ``dedupe`` (default) one row per media ``id``.

    Many users list the same media, so the per-entry fan-out repeats ids; the
    latest (run, document, entry) copy wins. ``dedupe=False`` keeps the fan-out.
    ``keys``: ``media_keys`` of the same entries.
    """
    from ..schemas import MEDIA_COLUMNS
    rows = dimension_media_rows(entries, strict_dates)
    if not dedupe:
        return rows.select(*MEDIA_COLUMNS)
    order = [c for c in ("run_id", "doc_id", "entry_id") if c in rows.columns]
    return latest_per_key(rows, "id", order, MEDIA_COLUMNS[1:], keys).select(*MEDIA_COLUMNS)


def dimension_user_rows(stg_user: DataFrame) -> DataFrame:
    u = F.col("data")
    keys = [c for c in ("run_id", "doc_id") if c in stg_user.columns]
    return stg_user.select(
        *keys,
        u["id"].cast("long").alias("id"),
        u["name"].alias("name"),
        u["avatar"]["large"].alias("avatar"),
        u["bannerImage"].alias("banner_image"),
        u["siteUrl"].alias("site_url"),
        u["statistics"].alias("statistics"),
    )


def dimension_user(stg_user: DataFrame, dedupe: bool = True) -> DataFrame:
    """User dimension; one row per user ``id`` (latest run/document) with ``dedupe``."""
    from ..schemas import USER_COLUMNS
    rows = dimension_user_rows(stg_user)
    if not dedupe:
        return rows.select(*USER_COLUMNS)
    order = [c for c in ("run_id", "doc_id") if c in rows.columns]
    return latest_per_key(rows, "id", order, USER_COLUMNS[1:]).select(*USER_COLUMNS)
