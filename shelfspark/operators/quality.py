"""Declarative data-quality checks, each table checked in one aggregate pass.

A table that is being written is checked by the write itself (``observed``):
rows and nulls are counted as they pass, and only ``unique`` reads its one
column again. The mart is checked on its keys, without being built.

A check result row: ``model, check, column, failures, rows, passed``.
``assert_passed`` is the blocking gate: it reads the (tiny, one row per
check) report and raises before dependents are written.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from . import mart

REPORT_COLUMNS = ["model", "check_name", "column_name", "failures", "rows", "passed"]

# Messages of the failed checks.
NO_ROWS_MESSAGE = "no rows processed"
RAW_INVALID_MESSAGE = "raw_anilist validation failed"


@dataclass
class TableChecks:
    model: str
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    non_empty: bool = False
    expected_rows: Column | int | None = None
    # A column that tells how many rows of the model a row stands for (then without ``unique``).
    weight: str | None = None


def _row(model: str, check: str, column: str | None, failures: Column, rows: Column,
         passed: Column) -> Column:
    return F.struct(F.lit(model).alias("model"), F.lit(check).alias("check_name"),
                    F.lit(column).cast("string").alias("column_name"),
                    failures.cast("long").alias("failures"), rows.cast("long").alias("rows"),
                    passed.alias("passed"))


def _counts(spec: TableChecks) -> list[Column]:
    """Rows, and nulls a column; without distinct aggregates, so a write may count them."""
    n = F.col(spec.weight) if spec.weight else F.lit(1)
    total = lambda present: F.coalesce(F.sum(F.when(present, n).otherwise(0)), F.lit(0)).cast("long")
    return [total(F.lit(True)).alias("_rows"), *(total(F.col(c).isNull()).alias(f"_nn_{c}") for c in spec.not_null)]


def _repeats(spec: TableChecks) -> list[Column]:
    """NULLs are not compared (as in SQL unique tests): non-null count - distinct count."""
    return [(F.count(F.col(c)) - F.count_distinct(F.col(c))).alias(f"_uq_{c}") for c in spec.unique]


def _results(stats: DataFrame, spec: TableChecks) -> DataFrame:
    """A row per check from one row of counts."""
    rows = F.col("_rows")
    results = []
    if spec.non_empty:
        results.append(_row(spec.model, "non_empty", None, F.when(rows == 0, 1).otherwise(0), rows, rows > 0))
    if spec.expected_rows is not None:
        exp = spec.expected_rows if isinstance(spec.expected_rows, Column) else F.lit(spec.expected_rows)
        results.append(_row(spec.model, "row_count", None, F.abs(rows - exp), rows, rows == exp))
    for check, prefix, columns in (("not_null", "_nn_", spec.not_null), ("unique", "_uq_", spec.unique)):
        for c in columns:
            f = F.col(prefix + c)
            results.append(_row(spec.model, check, c, f, rows, f == 0))
    return stats.select(F.inline(F.array(*results))).select(*REPORT_COLUMNS)


def check_table(df: DataFrame, spec: TableChecks) -> DataFrame:
    """All checks of one table from a single ``agg`` (one scan, one small shuffle per distinct)."""
    return _results(df.agg(*_counts(spec), *_repeats(spec)), spec)


def observed(df: DataFrame, spec: TableChecks) -> tuple[DataFrame, Observation]:
    """``df`` that counts what ``spec`` needs while it is written.

    Write it as it is: the counts are taken in the writing stage, where a task
    that runs again counts once.
    """
    seen = Observation()
    return df.observe(seen, *_counts(spec)), seen


def observed_checks(seen: Observation, spec: TableChecks, written: DataFrame) -> DataFrame:
    """The checks of a written table from its write's counts; ``unique`` scans its column of ``written``."""
    counts = [F.lit(value).cast("long").alias(name) for name, value in seen.get.items()]
    if spec.unique:
        stats = written.agg(*_repeats(spec)).select("*", *counts)
    else:
        stats = written.sparkSession.range(1).select(*counts)
    return _results(stats, spec)


def raw_checks(seen: Observation, raw: DataFrame, documents: int) -> DataFrame:
    """The row count of the raw table and the null checks of both staged models, from its write's counts."""
    counts = {name: F.lit(value).cast("long") for name, value in seen.get.items()}
    one = raw.sparkSession.range(1)
    out = _results(one.select(counts["_rows"].alias("_rows")), TableChecks("raw_anilist", expected_rows=documents))
    for member, spec in zip(RAW_COUNTS.not_null, STAGED_CHECKS.values()):
        stats = one.select(counts["_rows"].alias("_rows"), counts[f"_nn_{member}"].alias("_nn_data"))
        out = out.unionByName(_results(stats, spec))
    return out


def quality_report(checks: list[tuple[DataFrame, TableChecks]]) -> DataFrame:
    out = None
    for df, spec in checks:
        part = check_table(df, spec)
        out = part if out is None else out.unionByName(part)
    return out


def failed_checks(report: DataFrame) -> DataFrame:
    return report.where(~F.col("passed"))


def assert_passed(report: DataFrame) -> None:
    """Blocking gate: raise if any check failed (the report is one row per check)."""
    bad = failed_checks(report).collect()
    if bad:
        lines = [f"{r.model}.{r.column_name or '*'} {r.check_name}: {r.failures} failing of {r.rows}" for r in bad]
        if any(r.check_name == "non_empty" for r in bad):
            lines.insert(0, NO_ROWS_MESSAGE)
        raise AssertionError("; ".join(lines))


def preview(df: DataFrame, key: str = "id", n: int = 5,
            drop: tuple[str, ...] = ("stats", "rankings", "statistics", "genres", "tags", "synonyms")) -> DataFrame:
    """Last ``n`` rows by ``key`` without the nested columns (a top-k, not a full sort)."""
    return df.drop(*drop).orderBy(F.col(key).desc_nulls_last()).limit(n)


# The declarative tests of the SQL models (not-null, unique) plus non-empty gates.
STAGED_CHECKS = {"media": TableChecks("stg_media", not_null=["data"]),
                 "user": TableChecks("stg_user", not_null=["data"])}
# What the write of the raw table counts: rows, and the staged members that are null.
RAW_COUNTS = TableChecks("raw_anilist", not_null=["data.MediaListCollection", "data.User"])
TABLE_CHECKS = {
    "fact_anime": TableChecks("fact_anime", not_null=["id", "user_id", "media_id"], unique=["id"], non_empty=True),
    "dimension_user": TableChecks("dimension_user", not_null=["id", "name"], unique=["id"], non_empty=True),
    "dimension_media": TableChecks("dimension_media", not_null=["id"], unique=["id"], non_empty=True),
}
MART_CHECKS = TableChecks("anime_scores", not_null=["user_id", "media_id"], non_empty=True, weight="n")


def standard_checks(models) -> list[tuple[DataFrame, TableChecks]]:
    """Every model with its checks; the mart by its keys."""
    presence = models.stg_presence()
    tables = {"fact_anime": models.fact, "dimension_user": models.users, "dimension_media": models.media}
    return [*((presence.select(F.col(c).alias("data")), spec) for c, spec in STAGED_CHECKS.items()),
            *((tables[name], spec) for name, spec in TABLE_CHECKS.items()),
            (mart.mart_keys(models.fact, models.users, models.media), MART_CHECKS)]
