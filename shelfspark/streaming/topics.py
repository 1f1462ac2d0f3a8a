"""Fan documents out to event topics and replay a topic log.

Events are ``(topic STRING, value STRING)`` rows: one ``raw_user`` event per
run and user (the ``User`` object) and one ``raw_media`` event per list entry,
JSON-encoded. The same functions work on batch and streaming DataFrames, and
the per-row ``topic`` column routes rows (no per-topic jobs).

Sinks: a file-backed topic log (``<root>/topic=<name>/part-*.txt.gz``, one JSON
value per line) that always works, and Kafka when its connector is on the
classpath. Replay reads every topic from the start as a bounded stream
(``trigger(availableNow=True)``) and stops when the log is drained.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import explode_entries, stage_media

# Topic names.
RAW_USER_TOPIC = "raw_user"
RAW_MEDIA_TOPIC = "raw_media"
DEFAULT_TOPICS = (RAW_USER_TOPIC, RAW_MEDIA_TOPIC)

_JSON_OPTS = {"ignoreNullFields": "false"}

# A log's files are gzip, so a file is read by one task and its events are limited.
MAX_EVENTS_PER_FILE = 500_000
_LOG_FILES = {"compression": "gzip", "maxRecordsPerFile": str(MAX_EVENTS_PER_FILE)}


# How long a stream remembers a user that it has sent.
REMEMBER_USERS = "1 day"


def topic_events(raw: DataFrame, remember: str = REMEMBER_USERS) -> DataFrame:
    """``(topic, value)``: 1 user event per run and user + 1 media event per entry.

    A user's list may be spread over several documents that repeat the user
    object; it is one event all the same. A document without a user id stands
    for itself. On a stream a user is remembered for ``remember`` after its
    arrival, so the state holds the users of that time only; documents of one
    run and user that arrive further apart give an event each.
    """
    keys = ["run_id", "user_id", "unnamed"]
    user_id = F.coalesce(F.col("data.User.id"), F.col("doc_id"))
    users = (raw.select("run_id", user_id.alias("user_id"), F.col("data.User.id").isNull().alias("unnamed"),
                        F.to_json(F.col("data.User"), _JSON_OPTS).alias("value")))
    if raw.isStreaming:
        users = (users.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", remember)
                 .dropDuplicatesWithinWatermark(keys))
    else:
        users = users.dropDuplicates(keys)
    users = users.select(F.lit(RAW_USER_TOPIC).alias("topic"), "value")
    entries = explode_entries(stage_media(raw)).select(
        F.lit(RAW_MEDIA_TOPIC).alias("topic"), F.to_json(F.col("entry"), _JSON_OPTS).alias("value"))
    return users.unionByName(entries)


def topic_counts(events: DataFrame) -> DataFrame:
    """Events per topic (partial counts combine map-side)."""
    return events.groupBy("topic").agg(F.count(F.lit(1)).alias("events"))


def write_topic_log(events: DataFrame, root: str, mode: str = "append") -> None:
    """Append events to the file topic log, one folder per topic."""
    (events.select("topic", "value").write.mode(mode).options(**_LOG_FILES)
     .partitionBy("topic").text(root))


def write_kafka(events: DataFrame, bootstrap_servers: str) -> None:
    """Produce events to Kafka (needs the spark-sql-kafka connector on the classpath)."""
    (events.select("topic", F.col("value").cast("binary").alias("value")).write
     .format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).save())


def read_kafka(spark: SparkSession, bootstrap_servers: str,
               topics: tuple[str, ...] = DEFAULT_TOPICS) -> DataFrame:
    """Bounded batch read of all topics from earliest to latest offsets."""
    return (spark.read.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest").option("endingOffsets", "latest")
            .load().select("topic", F.col("value").cast("string").alias("value")))


def stream_documents_to_topic_log(spark: SparkSession, landed_root: str, log_root: str,
                                  checkpoint: str, available_now: bool = True,
                                  remember: str = REMEMBER_USERS):
    """Fan landed documents out to the topic log as a stream.

    New run folders landed under ``landed_root`` are picked up incrementally;
    the checkpoint records which files were produced, so a restart neither
    loses nor repeats events. ``available_now`` drains what is there and stops.
    Returns the started query.
    """
    from pyspark.sql.types import StringType, StructField, StructType

    from ..schemas import RAW_DOCUMENT
    schema = StructType(RAW_DOCUMENT.fields + [StructField("run_id", StringType(), True)])
    docs = (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", 64).json(landed_root))
    writer = (topic_events(docs, remember).writeStream.format("text")
              .options(**_LOG_FILES).option("path", log_root).option("checkpointLocation", checkpoint)
              .partitionBy("topic").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def decode(events: DataFrame) -> DataFrame:
    """Parse each value as JSON; undecodable values get ``decoded`` NULL."""
    return events.select("topic", "value", F.try_parse_json("value").alias("decoded"))


def replay_topic_log(spark: SparkSession, root: str, out_path: str, checkpoint: str,
                     topics: tuple[str, ...] = DEFAULT_TOPICS) -> DataFrame:
    """Drain the topic log from the start as a bounded stream into ``out_path``.

    Returns the delivered events ``(topic, value, valid)`` read back from the
    sink. The stream's checkpoint makes the drain restartable after a failure.
    """
    stream = (spark.readStream.format("text").load(root)
              .where(F.col("topic").isin(*topics)))
    delivered = decode(stream).select("topic", "value", F.col("decoded").isNotNull().alias("valid"))
    q = (delivered.writeStream.format("parquet")
         .option("compression", "zstd").option("path", out_path).option("checkpointLocation", checkpoint)
         .partitionBy("topic").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)


def replay_counts(delivered: DataFrame) -> DataFrame:
    return (delivered.groupBy("topic")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.count_if(F.col("valid")).alias("decoded")))
