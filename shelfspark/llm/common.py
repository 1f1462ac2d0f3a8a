"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` once to a new table in the shared folder and read it back.

    The folder is the one that ``spark.checkpoint.dir`` names, so the table
    outlives any executor. The schema is passed on, so an empty table reads too.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def fold(id_column, folds: int):
    """crc32 of the id's decimal text modulo ``folds`` (a null id is fold 0 of the empty text)."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds


def join_hot(big: DataFrame, small: DataFrame, keys: list[str], weight: str,
             how: str = "inner") -> DataFrame:
    """Join (inner or left) where few keys may hold much of ``big``; ``small`` has a key once.

    ``weight`` is the number of rows of ``big`` that a key has. The 1,000 heaviest
    keys are broadcast (a fixed bound), so their rows are not shuffled at all; any
    other key has at most a thousandth of the rows.
    """
    heavy = stored(small.orderBy(F.desc(weight), *keys).limit(1000), "heavy-keys")
    light = small.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    rest = big.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return (big.join(F.broadcast(heavy), keys)
            .unionByName(rest.join(light, keys, how)))


def likely(rows: DataFrame, ids: DataFrame, column: str, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: ``column`` is probably among ``ids`` (same name); no shuffle of ``rows``.

    A bitmap of hashed ids is broadcast: 64 bits an id, 16 MB at most. Every row
    whose value is among ``ids`` is flagged, and few others; an exact join of the
    flagged rows tells them apart.
    """
    bits = 1 << min(27, max(15, (64 * max(1, ids.count())).bit_length()))
    at = F.pmod(F.xxhash64(column), F.lit(bits))
    bucket, place, bitmap = (free_name(rows, x) for x in ("bucket", "place", "bitmap"))
    seen = ids.groupBy(F.bitmap_bucket_number(at).alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias(bitmap))
    byte = f"cast(conv(hex(substring(`{bitmap}`, cast(`{place}` div 8 as int) + 1, 1)), 16, 10) as int)"
    return (rows.withColumn(bucket, F.bitmap_bucket_number(at)).withColumn(place, F.bitmap_bit_position(at))
            .join(F.broadcast(seen), bucket, "left")
            .withColumn(flag, F.expr(f"coalesce((shiftright({byte}, cast(`{place}` % 8 as int)) & 1) = 1, false)"))
            .select(*[f"`{c}`" for c in rows.columns], flag))


def likely_in(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows that ``likely`` flags."""
    flag = free_name(rows, "flagged")
    return likely(rows, ids, column, flag).filter(f"`{flag}`").drop(flag)


class Shared:
    """A broadcast of any object, by value: executors do not need this package to read it."""

    def __init__(self, spark: SparkSession, value):
        self._data = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if "_value" not in self.__dict__:
            self._value = cloudpickle.loads(self._data.value)
        return self._value

    def __getstate__(self):
        return {"_data": self._data}


def byte_level() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
