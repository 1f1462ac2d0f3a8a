"""Landing of raw documents and the warehouse tables built from them.

* ``land_json``: run-scoped JSON sink, ``<root>/run_id=<id>/part-*.json``,
  one document per line. Files are gzip, so a file is read by one task and the
  documents per file are limited.
* ``read_landed``: read-back with the fixed schema; a ``run_id`` filter is a
  partition filter, so other runs' folders are never listed or read.
* ``read_landed_variant``: the same files as one VARIANT column per line, for
  checks that must tell a missing key from an explicit ``null``.
* ``write_raw_table``: the replaced raw table (parquet, nested columns
  prunable), the input of every model.
* ``save_table`` / ``create_view`` / ``create_mart_view``: named tables in a schema and views.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType, VariantType

from .. import schemas
from ..operators import mart
from .fixtures import DEFAULT_MAX_ENTRIES

# A gzip part file is read by one task (gzip is not splittable), so a file
# holds at most this many entries, for documents of the usual size.
MAX_ENTRIES_PER_FILE = 1_000_000
MAX_DOCUMENTS_PER_FILE = MAX_ENTRIES_PER_FILE // DEFAULT_MAX_ENTRIES
# Landed lines are written and read by one job: a lower level takes a quarter more room and half the time.
GZIP_LEVEL = {"zlib.compress.level": "THREE"}


def land_json(docs: DataFrame, root: str, compression: str = "gzip") -> None:
    """Write documents under their run folders; only the runs present are replaced."""
    (docs.select("run_id", "doc_id", "data").write
     .mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", compression)
     .option("maxRecordsPerFile", MAX_DOCUMENTS_PER_FILE)
     .options(**GZIP_LEVEL)
     .partitionBy("run_id")
     .json(root))


def read_landed(spark: SparkSession, root: str, run_id: str | None = None, faults: bool = False,
                schema: StructType = schemas.RAW_DOCUMENT) -> DataFrame:
    """Typed documents. Numbers given as text, or with a fraction, are cast as SQL casts them.

    ``faults``: also the column ``cast_faults``; ``schema``: the members to read; see ``documents_from_text``.
    """
    return documents_from_text(read_landed_text(spark, root, run_id), faults=faults, schema=schema)


def read_landed_variant(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    """``(run_id, doc, n_bytes)``: each landed line parsed as VARIANT, with its ``dumped_size``.

    Read as text then ``parse_json`` (the reader's single-variant-column mode
    does not combine with run partition folders in this Spark version).
    """
    return read_landed_text(spark, root, run_id).select(
        "run_id", F.try_parse_json("value").alias("doc"), dumped_size(F.col("value")).alias("n_bytes"))


def read_landed_text(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    """``(run_id, value)``: each landed line as text (for byte sizes)."""
    df = spark.read.text(root)
    if run_id is not None:
        df = df.where(F.col("run_id") == run_id)
    return df


def write_raw_table(raw: DataFrame, path: str, compression: str | None = None) -> None:
    """Replace the raw table (parquet, partitioned by run); ``cast_faults`` is kept if it is there."""
    faults = [c for c in raw.columns if c == "cast_faults"]
    (raw.select("run_id", "doc_id", "data", *faults).write.mode("overwrite")
     .partitionBy("run_id").parquet(path, compression=compression))


def read_raw_table(spark: SparkSession, path: str, run_id: str | None = None,
                   schema=None) -> DataFrame:
    """The raw table; ``schema`` narrows the read to the named leaves (must keep ``run_id``)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if run_id is not None:
        df = df.where(F.col("run_id") == run_id)
    return df.select("run_id", "doc_id", "data")


# One leaf under each top-level member: parquet rebuilds a struct's nullness
# from any leaf's definition levels, so null tests on ``MediaListCollection``
# and ``User`` read only these leaves instead of whole documents.
PRESENCE_SCHEMA = ("doc_id bigint, data struct<MediaListCollection: struct<lists: array<struct<name: string>>>, "
                   "User: struct<id: bigint>>, run_id string")


def save_table(df: DataFrame, schema_name: str, table: str, path: str | None = None) -> str:
    """Replace ``<schema_name>.<table>`` (the schema name is used verbatim), at ``path`` if one is given."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema_name}`")
    name = f"`{schema_name}`.`{table}`"
    writer = df.write.mode("overwrite").format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return name


def create_mart_view(spark: SparkSession, schema_name: str, view: str = "anime_scores") -> str:
    """The 27-column mart as a lasting view over the saved tables of a schema.

    Any session of the catalog reads it by name; one that has read it before lists
    replaced tables anew after ``REFRESH TABLE``.
    """
    def columns(side: str, names: list[str]) -> str:
        return ", ".join(f"{side}.{n}" for n in names)
    media = {"english_title": "title.english", "native_title": "title.native", "romaji_title": "title.romaji"}
    inner = ", ".join(f"{media[c]} AS {c}" if c in media else c for c in mart.MEDIA_UNNESTED_COLUMNS)
    name = f"`{schema_name}`.`{view}`"
    spark.sql(f"""
        CREATE OR REPLACE VIEW {name} AS
        SELECT {columns("f", mart.STATS_COLUMNS)}, u.id, u.name, m.id AS id_1,
               {columns("m", mart.MEDIA_UNNESTED_COLUMNS[1:])}
        FROM `{schema_name}`.fact_anime f
        JOIN `{schema_name}`.dimension_user u ON f.user_id = u.id
        JOIN (SELECT {inner} FROM `{schema_name}`.dimension_media
              LATERAL VIEW inline(arrays_zip(coalesce(synonyms, array()), coalesce(genres, array()),
                                             coalesce(tags.name, array()))) z AS synonym, genre, tag) m
          ON f.media_id = m.id""")
    return name


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a (temporary) view and return the view scan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def dumped_size(value: Column) -> Column:
    """Bytes of the JSON text ``value`` written again with a blank after each comma and colon, and ASCII only.

    A character outside blank to tilde takes six bytes as an escape, one beyond
    the basic plane twelve; short escapes that the text already has stay as they
    are. Numbers and escapes count as they stand in the text.
    """
    structure = F.regexp_replace(value, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', "")
    separators = F.length(structure) - F.length(F.translate(structure, ",:", ""))
    # what is taken out goes by runs, and only from texts that hold a character to escape
    escaped = F.length(F.regexp_replace(value, "[ -~]++", ""))
    wide = F.length(F.regexp_replace(value, r"[^\x{10000}-\x{10FFFF}]++", ""))
    more = F.when(value.rlike(r"^[ -~]*+\z"), F.lit(0)).otherwise(5 * escaped + 6 * wide)
    return (F.length(value) + separators + more).cast("long")


def documents_from_text(lines: DataFrame, run_id_col: str = "run_id", faults: bool = False,
                        schema: StructType = schemas.RAW_DOCUMENT) -> DataFrame:
    """Typed documents ``(run_id, doc_id, data)`` from JSON text lines ``(run_id?, value)``.

    ``faults``: also ``cast_faults``, the paths of the numbers that are there but
    cannot be cast (and so are NULL in ``data``), one per occurrence. Members
    that the models pass on as JSON (``tags``) are not cast and have none.
    ``schema``: like the whole document's with the members that are needed only
    (``schemas.FACT_RAW_SCHEMA``); others are neither parsed nor cast.
    """
    schema = StructType([f for f in schema if f.name != "run_id"])  # of the folder, not of the line
    run = F.col(run_id_col) if run_id_col in lines.columns else F.lit(None).cast("string")
    parsed = lines.select(run.alias("run_id"), F.from_json("value", _loose(schema)).alias("d"))
    return parsed.select("run_id", _typed(F.col("d.doc_id"), schema["doc_id"].dataType).alias("doc_id"),
                         _typed(F.col("d.data"), schema["data"].dataType).alias("data"),
                         *([_faults(F.col("d"), schema, "$").alias("cast_faults")] if faults else []))


def cast_faults(docs: DataFrame) -> DataFrame:
    """``(path, n)``: how many values of each path could not be cast, from documents read with their faults."""
    # a one-row generator: a filter on its output does not move below it, where it would parse the text again
    found = docs.select(F.inline(F.array(F.struct("cast_faults"))))
    return (found.where(F.size("cast_faults") > 0).select(F.explode("cast_faults").alias("path"))
            .groupBy("path").agg(F.count(F.lit(1)).alias("n")))


def _loose(kind):
    """``kind`` with every number read as VARIANT, which keeps text and fractions."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _loose(f.dataType)) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(_loose(kind.elementType))
    return VariantType() if isinstance(kind, (LongType, DoubleType)) else kind


def _typed(value: Column, kind) -> Column:
    """The loosely read ``value`` as ``kind``: integers rounded half to even, text numbers cast."""
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*[_typed(value[f.name], f.dataType).alias(f.name) for f in kind]))
    if isinstance(kind, ArrayType) and _loose(kind) != kind:
        return F.transform(value, lambda x: _typed(x, kind.elementType))
    if isinstance(kind, LongType):
        whole = F.try_variant_get(value, "$", "bigint")
        exact = F.try_variant_get(value, "$", "decimal(38,9)")
        # a plain integer needs no decimal; 2.5 would be cut by the first cast
        return F.when(F.schema_of_variant(value) == "BIGINT", whole).otherwise(F.bround(exact, 0).cast("long"))
    if isinstance(kind, DoubleType):
        return F.try_variant_get(value, "$", "double")
    return value


def _faults(value: Column, kind, path: str) -> Column:
    """Paths of the numbers in the loosely read ``value`` that ``_typed`` makes NULL."""
    none = F.array().cast("array<string>")
    if isinstance(kind, StructType):
        inner = [_faults(value[f.name], f.dataType, f"{path}.{f.name}") for f in kind
                 if f.name not in schemas.UNCAST_MEMBERS and _loose(f.dataType) != f.dataType]
        return F.when(value.isNotNull(), F.concat(*inner)).otherwise(none)
    if isinstance(kind, ArrayType):
        lists = F.transform(value, lambda x: _faults(x, kind.elementType, path + "[*]"))
        return F.coalesce(F.flatten(lists), none)
    lost = value.isNotNull() & ~F.is_variant_null(value) & _typed(value, kind).isNull()
    if isinstance(kind, LongType):  # what is an integer, or is cut to one, can be cast: most values need no more
        lost = F.try_variant_get(value, "$", "bigint").isNull() & lost
    return F.when(lost, F.array(F.lit(path))).otherwise(none)


def variant_documents_from_text(lines: DataFrame, run_id_col: str = "run_id") -> DataFrame:
    """VARIANT documents ``(run_id, doc, n_bytes)`` from JSON text lines."""
    run = F.col(run_id_col) if run_id_col in lines.columns else F.lit(None).cast("string")
    return lines.select(run.alias("run_id"), F.try_parse_json("value").alias("doc"),
                        dumped_size(F.col("value")).alias("n_bytes"))
