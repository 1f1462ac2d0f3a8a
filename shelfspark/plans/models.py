"""Lazily built tables for one set of raw documents (all share one lineage)."""

from __future__ import annotations

import hashlib
import uuid
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import mart as mart_ops
from ..operators import models as model_ops
from ..operators import quality, staging
from ..session import scratch_path, shuffles_for
from ..sources import fixtures, landing
from ..sources.parquet import write_parquet

# Session setting naming a landed raw-document table (parquet folder) to use
# instead of deriving documents from the driver tables on the fly.
RAW_TABLE_CONF = "shelfspark.raw.table"
# Session setting naming a folder of materialized model tables
# (``<sf_dir>=<folder>``, written by ``Models.materialize``).
MODELS_CONF = "shelfspark.models.path"
MODELS_DB_CONF = "shelfspark.models.database"
DEFAULT_DATABASE = "shelfspark_models"


def bucketed_name(root: str, name: str) -> str:
    """The catalog name of a bucketed table: one for each folder, so builds do not meet."""
    return f"{name}_{hashlib.md5(root.rstrip('/').encode()).hexdigest()[:16]}"


MODEL_TABLES = ("fact_anime", "dimension_media", "dimension_user")


def raw_table_reader(spark: SparkSession, path: str, run_id: str | None = None):
    """``schema -> DataFrame`` reading the raw table at ``path`` with that schema."""
    return lambda schema: landing.read_raw_table(spark, path, run_id, schema=schema)


def _conf_path(spark: SparkSession, key: str, sf_dir: str) -> str | None:
    setting = spark.conf.get(key, "") or ""
    if "=" in setting:
        src, path = setting.split("=", 1)
        if src.rstrip("/") == sf_dir.rstrip("/"):
            return path
    return None


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw documents ``(run_id, doc_id, data)`` for a driver-table folder.

    If the session names a landed raw table for this folder (``RAW_TABLE_CONF``,
    value ``<sf_dir>=<table path>``), read it; otherwise derive the documents
    from the driver tables in the same plan.
    """
    path = _conf_path(spark, RAW_TABLE_CONF, sf_dir)
    if path:
        return spark.read.parquet(path)
    staged = scratch_path(spark, f"entry-facts-{uuid.uuid4().hex}")
    return fixtures.build_documents(spark, sf_dir, staging_path=staged)


# Raw tables written by this process, by session, folder and state of its files.
_STORED: dict[tuple[str, str, int], str] = {}


def stored_documents(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the raw table of a driver-table folder, written once: every model reads the leaves it needs."""
    sf_dir = sf_dir.rstrip("/")
    files = spark.read.format("binaryFile").load([f"{sf_dir}/{t}.parquet" for t in fixtures.SOURCE_TABLES])
    state = files.select(F.xxhash64("path", "modificationTime", "length").alias("h")).agg(F.bit_xor("h")).first()[0]
    key = (spark.sparkContext.applicationId, sf_dir, state)
    if key not in _STORED:
        run = uuid.uuid4().hex
        root = scratch_path(spark, f"raw-documents-{run}")
        docs = fixtures.build_documents(spark, sf_dir, staging_path=scratch_path(spark, f"entry-facts-{run}"))
        with shuffles_for(spark, fixtures.line_count(spark, sf_dir)):
            landing.write_raw_table(docs, root, compression="zstd")
        _STORED[key] = root
    return _STORED[key]


class Models:
    """fact / dimension / mart DataFrames over one raw-document DataFrame."""

    def __init__(self, raw: DataFrame, strict_dates: bool = True, latest_run_only: bool = False):
        # ``latest_run_only``: when several landed runs are read together, each
        # user's latest run wins (the single-run case is unaffected).
        self.raw = staging.latest_runs(raw) if latest_run_only else raw
        self._latest_run_only = latest_run_only
        self.strict_dates = strict_dates

    @classmethod
    def for_tables(cls, spark: SparkSession, sf_dir: str) -> "Models":
        """Models for a driver-table folder: materialized tables if the session names them."""
        path = _conf_path(spark, MODELS_CONF, sf_dir)
        raw_path = _conf_path(spark, RAW_TABLE_CONF, sf_dir)
        if path:
            db = spark.conf.get(MODELS_DB_CONF, "") or None
            m = MaterializedModels(spark, path, raw_documents(spark, sf_dir), database=db)
        else:
            raw_path = raw_path or stored_documents(spark, sf_dir)
            m = cls(spark.read.parquet(raw_path))
        if raw_path:
            m.raw_reader = raw_table_reader(spark, raw_path)
        return m

    # ``raw_reader(schema)`` re-reads the same raw documents with a narrowed
    # schema (same table, same run filter), when the raw table is known.
    raw_reader = None

    def _narrow(self, schema) -> DataFrame | None:
        if self.raw_reader is None or self._latest_run_only:
            return None
        return self.raw_reader(schema)

    def stg_presence(self) -> DataFrame:
        """``(media, user)``: the staged members, for null checks.

        With a raw reader the table is read narrowed to one leaf per member
        (exact nullness, a tiny read); otherwise from ``raw``.
        """
        src = self._narrow(landing.PRESENCE_SCHEMA)
        src = self.raw if src is None else src
        return src.select(F.col("data.MediaListCollection").alias("media"), F.col("data.User").alias("user"))

    def narrow_fact(self) -> DataFrame:
        """The fact table built from a raw read narrowed to the fact's leaves."""
        from .. import schemas
        return model_ops.fact_anime(self._entries(schemas.FACT_RAW_SCHEMA), self.strict_dates)

    def _entries(self, schema) -> DataFrame:
        """The entries, with the members that ``schema`` names if the raw table is known."""
        src = self._narrow(schema)
        return self.entries if src is None else staging.explode_entries(staging.stage_media(src))

    def materialize(self, root: str, buckets: int | None = None,
                    database: str | None = None) -> "MaterializedModels":
        """Write fact and (deduplicated) dimension tables as parquet under ``root``.

        The documents are exploded and validated once; every later query
        scans flat columns (column pruning and filter pushdown reach the
        files), and the written tables cut the lineage back to the documents.

        With ``buckets`` (and a ``database`` in the session catalog), the fact
        table is bucketed by ``user_id`` and the user table by ``id`` into the
        same number of buckets, so the fact x user join is co-located and the
        fact is never shuffled for it. The tables stay external at ``root``.

        The writes count what the standard checks need (``quality_report``).
        """
        out = MaterializedModels(self.raw.sparkSession, root, self.raw,
                                 database=(database or DEFAULT_DATABASE) if buckets else None)
        out.raw_reader = self.raw_reader
        if buckets:
            out._spark.sql(f"CREATE DATABASE IF NOT EXISTS `{out.database}`")
        for name, df, key in (("fact_anime", self.narrow_fact(), "user_id"),
                              ("dimension_media", self.media, None), ("dimension_user", self.users, "id")):
            df, out.observed[name] = quality.observed(df, quality.TABLE_CHECKS[name])
            if buckets and key:
                (df.write.mode("overwrite").format("parquet").option("path", f"{root}/{name}")
                 .bucketBy(buckets, key).sortBy(key).saveAsTable(f"`{out.database}`.`{bucketed_name(root, name)}`"))
            else:
                write_parquet(df, f"{root}/{name}")
        return out

    @cached_property
    def stg_media(self) -> DataFrame:
        return staging.stage_media(self.raw)

    @cached_property
    def stg_user(self) -> DataFrame:
        return staging.stage_user(self.raw)

    @cached_property
    def entries(self) -> DataFrame:
        return staging.explode_entries(self.stg_media)

    @cached_property
    def fact(self) -> DataFrame:
        return self.narrow_fact()

    @cached_property
    def media(self) -> DataFrame:
        from .. import schemas
        return model_ops.dimension_media(self._entries(schemas.MEDIA_RAW_SCHEMA), dedupe=True,
                                         strict_dates=self.strict_dates,
                                         keys=model_ops.media_keys(self._entries(schemas.MEDIA_KEYS_RAW_SCHEMA)))

    @cached_property
    def users(self) -> DataFrame:
        return model_ops.dimension_user(self.stg_user, dedupe=True)

    @cached_property
    def mart(self) -> DataFrame:
        return mart_ops.anime_scores(self.fact, self.users, self.media)

    @cached_property
    def mart_wide(self) -> DataFrame:
        return mart_ops.anime_scores_wide(self.fact, self.users, self.media)


class MaterializedModels(Models):
    """Models whose fact and dimension tables are read from parquet."""

    def __init__(self, spark: SparkSession, root: str, raw: DataFrame, database: str | None = None):
        super().__init__(raw)
        self.root = root.rstrip("/")
        self._spark = spark
        self.database = database
        # table name -> what its write counted, if this session wrote it
        self.observed: dict[str, Observation] = {}

    def quality_report(self) -> DataFrame:
        """The checks of the three tables and of the mart on the counts of this session's writes."""
        parts = [quality.observed_checks(seen, quality.TABLE_CHECKS[name], self._read(name))
                 for name, seen in self.observed.items()]
        keys = mart_ops.mart_keys(self.fact, self.users, self.media)
        parts.append(quality.check_table(keys, quality.MART_CHECKS))
        return reduce(DataFrame.unionByName, parts)

    def _read(self, name: str) -> DataFrame:
        # bucketed tables are read through the catalog so the bucket spec is known
        table = bucketed_name(self.root, name)
        if self.database and self._spark.catalog.tableExists(f"{self.database}.{table}"):
            return self._spark.table(f"`{self.database}`.`{table}`")
        return self._spark.read.parquet(f"{self.root}/{name}")

    @cached_property
    def fact(self) -> DataFrame:
        return self._read("fact_anime")

    @cached_property
    def media(self) -> DataFrame:
        return self._spark.read.parquet(f"{self.root}/dimension_media")

    @cached_property
    def users(self) -> DataFrame:
        return self._read("dimension_user")


class ValidatedModels:
    """Validated-mode model set over VARIANT documents ``(run_id, doc, …)``.

    fact / media / users hold only rows that pass validation (dates as ISO
    text); the rejected rows are in ``fact_quarantine`` / ``media_quarantine``
    / ``user_quarantine``. Dimensions are de-duplicated like the SQL mode.
    """

    def __init__(self, docs: DataFrame, lines: DataFrame | None = None):
        # ``lines``: the same documents as JSON text ``(run_id, value)``; when
        # given, entries are parsed straight into records (faster).
        self.docs = docs
        self.lines = lines

    def _entries(self, keys: tuple[str, ...]) -> DataFrame:
        """Entries with one model's own members, so that none reads the other's."""
        from ..operators import validate
        if self.lines is not None:
            return validate.record_entries_from_text(self.lines, keys)
        return validate.variant_entries(self.docs, keys)

    @cached_property
    def _fact_split(self):
        from ..operators import validate
        return validate.validated_fact(self._entries(validate.FACT_KEYS))

    @cached_property
    def _media_split(self):
        from ..operators import validate
        from ..schemas import MEDIA_COLUMNS
        return validate.split_valid(validate.checked_media(self._entries(validate.MEDIA_KEYS)),
                                    ["run_id", "doc_id", "entry_id"] + MEDIA_COLUMNS)

    @cached_property
    def _user_split(self):
        from ..operators import validate
        from ..schemas import USER_COLUMNS
        return validate.split_valid(validate.checked_users(self.docs), ["run_id", "doc_id"] + USER_COLUMNS)

    @property
    def fact(self) -> DataFrame:
        return self._fact_split[0]

    @property
    def fact_quarantine(self) -> DataFrame:
        return self._fact_split[1]

    @cached_property
    def media(self) -> DataFrame:
        from ..schemas import MEDIA_COLUMNS
        # read twice by ``latest_per_key``, so the lines are parsed and checked once
        path = scratch_path(self.docs.sparkSession, f"checked-media-{uuid.uuid4().hex}")
        self._media_split[0].write.parquet(path, compression="zstd")
        good = self.docs.sparkSession.read.parquet(path)
        return model_ops.latest_per_key(good, "id", ["run_id", "doc_id", "entry_id"],
                                        MEDIA_COLUMNS[1:]).select(*MEDIA_COLUMNS)

    @property
    def media_quarantine(self) -> DataFrame:
        return self._media_split[1]

    @cached_property
    def users(self) -> DataFrame:
        from ..schemas import USER_COLUMNS
        # read twice by ``latest_per_key``, as the media are
        path = scratch_path(self.docs.sparkSession, f"checked-users-{uuid.uuid4().hex}")
        self._user_split[0].write.parquet(path, compression="zstd")
        good = self.docs.sparkSession.read.parquet(path)
        return model_ops.latest_per_key(good, "id", ["run_id", "doc_id"], USER_COLUMNS[1:]).select(*USER_COLUMNS)

    @property
    def user_quarantine(self) -> DataFrame:
        return self._user_split[1]

    @cached_property
    def mart(self) -> DataFrame:
        return mart_ops.anime_scores(self.fact, self.users, self.media)

    @cached_property
    def mart_wide(self) -> DataFrame:
        return mart_ops.anime_scores_wide(self.fact, self.users, self.media)
