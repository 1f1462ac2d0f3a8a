"""Staging: split documents into the media collection and the user, fan out entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("run_id", "doc_id")


def _keys(df: DataFrame) -> list[str]:
    return [k for k in KEYS if k in df.columns]


def stage_media(raw: DataFrame) -> DataFrame:
    """``data.MediaListCollection`` as ``data`` (one row per document)."""
    return raw.select(*_keys(raw), F.col("data.MediaListCollection").alias("data"))


def stage_user(raw: DataFrame) -> DataFrame:
    """``data.User`` as ``data`` (one row per document)."""
    return raw.select(*_keys(raw), F.col("data.User").alias("data"))


def explode_entries(stg_media: DataFrame) -> DataFrame:
    """List-of-lists -> one row per entry (list grouping dropped, duplicates kept).

    ``data.lists.entries`` is ``array<array<entry>>``; NULL inner arrays are
    removed first because ``flatten`` returns NULL if any inner array is NULL.
    A narrow transformation: no shuffle.
    """
    nested = F.filter(F.col("data.lists.entries"), lambda a: a.isNotNull())
    return stg_media.select(*_keys(stg_media), F.explode(F.flatten(nested)).alias("entry"))


def latest_runs(raw: DataFrame) -> DataFrame:
    """Keep, per user, only the documents of that user's latest run.

    Equal to the reference's overwrite-per-run when one run is read. The
    per-user latest run is a map-side-combined aggregate (one row per user);
    the documents are semi-joined with it, so no document is reordered or
    collected per user.
    """
    uid = F.col("data.User.id")
    latest = raw.groupBy(uid.alias("_uid")).agg(F.max("run_id").alias("_run"))
    cond = uid.eqNullSafe(latest["_uid"]) & (raw["run_id"] == latest["_run"])
    return raw.join(latest, cond, "left_semi")
