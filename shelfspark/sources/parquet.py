"""Parquet sink and source (the mart export and the ML input)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  compression: str | None = None) -> None:
    """Overwrite ``path`` with ``df`` as parquet (one file per task, no driver hop)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path, compression=compression)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
