"""SparkSession construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at runtime from real
# shuffle statistics (broadcast only when the measured side is small, split
# skewed partitions), so no join in the library hard-codes a broadcast.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # A raw-table row is a whole document (up to fixtures.DEFAULT_MAX_ENTRIES
    # entries), so a vectorized batch's memory is rows x entries per row; 512
    # rows keeps a batch bounded where the default 4096 can exhaust a task.
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "shelfspark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied.

    ``master`` is only set when given, so that spark-submit on a cluster keeps
    its own. ``spark.checkpoint.dir`` is left alone when the cluster names one;
    a local fallback is created only for local masters (tests, bench).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="shelfspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for job-owned intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


# Rows that a task of a shuffle holds at most, or so: they are sorted or grouped within its memory.
ROWS_PER_TASK = 500_000
# Compressed bytes up to which shuffle partitions are put together again.
BYTES_PER_TASK = 16 << 20


@contextmanager
def shuffles_for(spark: SparkSession, rows: int):
    """Shuffles of what is written inside deal ``rows`` rows out to enough tasks, so that none spills.

    The number of partitions of the session stays if it is enough; skewed ones are still split.
    """
    partitions, advisory = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    wanted = {}
    if rows > ROWS_PER_TASK:
        wanted[partitions] = max(int(spark.conf.get(partitions)), -(-rows // ROWS_PER_TASK))
        if spark.conf.get(advisory, None) is None:  # a size that was set stays
            wanted[advisory] = BYTES_PER_TASK
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
