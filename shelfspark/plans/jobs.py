"""End-to-end jobs with blocking quality gates.

``build``: landed run -> envelope gate -> raw table (+ row-count gate) ->
materialized models -> table checks (blocking) -> mart parquet export.
A failed gate raises before anything downstream is written. Only the tiny
check reports (one row per check / one count) reach the driver. Numbers and
dates are cast strictly unless told otherwise: a value that is no number where
one is cast, or an impossible date, fails the build as a failed gate that names
the paths. Faults are found by the read that writes the raw table.

``build_validated``: landed run -> envelope gate -> validated fact, media and
user tables with their rejected rows, and the documents that give no rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import quality, validate
from ..sources import landing, parquet
from .models import Models, ValidatedModels, raw_table_reader


class GateFailed(AssertionError):
    pass


def _envelope_gate(spark: SparkSession, landed_root: str, run_id: str):
    """Q1: every landed document has a valid envelope; a line that is not JSON has none."""
    docs_v = landing.read_landed_variant(spark, landed_root, run_id)
    env = validate.raw_envelope_check(docs_v).agg(
        F.count(F.lit(1)).alias("docs"), F.count_if(~F.col("passed")).alias("invalid"),
        F.sum("n_bytes").alias("bytes")).first()
    if env.docs == 0 or env.invalid:
        raise GateFailed(f"{quality.RAW_INVALID_MESSAGE}: {env.invalid} of {env.docs} documents")
    return env


def build_validated(spark: SparkSession, landed_root: str, run_id: str, out_root: str,
                    envelope_gate: bool = True) -> dict:
    """Write the validated tables and the quarantine; the rows of each.

    Without the gate, faulty documents go to ``document_quarantine`` and the
    rest is built.
    """
    out_root = out_root.rstrip("/")
    if envelope_gate:
        _envelope_gate(spark, landed_root, run_id)
    lines = landing.read_landed_text(spark, landed_root, run_id)
    models = ValidatedModels(landing.read_landed_variant(spark, landed_root, run_id), lines)
    rejected = validate.quarantine_rows({"fact_anime": models.fact_quarantine,
                                         "dimension_media": models.media_quarantine,
                                         "dimension_user": models.user_quarantine})
    out = {}
    for name, df in (("fact_anime", models.fact), ("dimension_media", models.media),
                     ("dimension_user", models.users), ("quarantine", rejected),
                     ("document_quarantine", validate.document_quarantine(lines))):
        parquet.write_parquet(df, f"{out_root}/{name}")
        out[name] = parquet.read_parquet(spark, f"{out_root}/{name}").count()
    return out


def build(spark: SparkSession, landed_root: str, run_id: str, out_root: str,
          buckets: int | None = None, database: str | None = None, strict_dates: bool = True,
          strict_casts: bool = True) -> dict:
    out_root = out_root.rstrip("/")
    env = _envelope_gate(spark, landed_root, run_id)
    # S1 + Q3: the raw table holds exactly the landed documents
    raw_path = f"{out_root}/raw_anilist"
    landed, seen = quality.observed(landing.read_landed(spark, landed_root, run_id, faults=strict_casts),
                                    quality.RAW_COUNTS)
    landing.write_raw_table(landed, raw_path)
    if strict_casts:  # a row per path of the schema at most
        lost = landing.cast_faults(spark.read.parquet(raw_path).where(F.col("run_id") == run_id)).orderBy("path").collect()
        if lost:
            raise GateFailed("values that cannot be cast; strict_casts=False makes them NULL: "
                             + ", ".join(f"{r.path} ({r.n})" for r in lost))
    raw = landing.read_raw_table(spark, raw_path, run_id)
    row_checks = quality.raw_checks(seen, raw, env.docs)
    # models, then the declarative checks on what their writes counted (blocking)
    staged = Models(raw, strict_dates=strict_dates)
    staged.raw_reader = raw_table_reader(spark, raw_path, run_id)
    try:
        models = staged.materialize(f"{out_root}/models", buckets=buckets, database=database)
    except Exception as err:
        if "DATETIME_FIELD_OUT_OF_BOUNDS" in str(err):
            raise GateFailed("an impossible date; strict_dates=False makes such dates NULL") from err
        raise
    report = models.quality_report().unionByName(row_checks)
    parquet.write_parquet(report, f"{out_root}/quality_report")
    report = parquet.read_parquet(spark, f"{out_root}/quality_report")
    try:
        quality.assert_passed(report)
    except AssertionError as err:
        raise GateFailed(str(err)) from err
    # S10: mart export
    parquet.write_parquet(models.mart, f"{out_root}/anime_scores.parquet")
    return {"documents": env.docs, "bytes": env.bytes, "out": out_root}
