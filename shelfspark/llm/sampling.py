"""Bounded samples of labelled rows, to fit classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_sample(rows: DataFrame, by: str, per_value: int, id_column: str = "doc_id"):
    """About ``per_value`` rows per value of ``by`` (at most 1.5 times as many), as an Arrow table.

    Rows are taken by a hash of their id, so the sample is the same in every
    run and does not depend on partitions; values with fewer rows are taken
    whole. ``by`` must have few values: their counts come to the driver.
    """
    at = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_column)), F.lit(1 << 40))
    counts = {r[0]: r[1] for r in rows.groupBy(by).count().collect()}
    take = F.lit(False)
    for value, n in counts.items():
        bound = int((1 << 40) * min(1.0, 1.2 * per_value / n)) if n > per_value else 1 << 40
        take = take | (F.col(by).eqNullSafe(F.lit(value)) & (at < bound))
    return rows.filter(take).orderBy(at, id_column).limit(int(1.5 * per_value * max(1, len(counts)))).toArrow()
