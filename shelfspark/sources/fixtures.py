"""Driver tables -> media-list documents (the engine's input shape).

A user's media list is derived from the order lines of one customer:
an entry per (customer, part), its media from ``part`` and the user from
``customer``. The whole derivation is Spark plans (join, two grouped
aggregates, nesting with bounded ``collect_list``); nothing passes through
the driver. What moves between tasks is narrow: the flat entry attributes and
the five ``part`` columns a media is made of. Entries with their media, and
their JSON text, are made where the document's rows have come together.

Documents are bounded: a user with more than ``max_entries`` entries is
split into several documents (chunks chosen by a hash of the entry id), so
a single very large list never becomes one giant row or one task's worth of
nesting. Each chunk repeats the ``User`` object, as paged API answers do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import shuffles_for
from .tables import read_table

FIXTURE_RUN_ID = "fixture"
SOURCE_TABLES = ("lineitem", "orders", "customer", "part")
DEFAULT_MAX_ENTRIES = 500
CHUNK_BITS = 20  # doc_id = user_id << 20 | chunk
# Entries of which one task makes the documents, if there are more than its share of them.
ENTRIES_PER_TASK = 500_000

# Fixed values of the bridge (FIXTURES.md section 3).
ENTRY_ID_SHIFT = 32  # entry id = customer key << 32 | part key, unique below 2^31 customers and 2^32 parts
SEASONS = ("WINTER", "SPRING", "SUMMER", "FALL")  # by p_size % 4
STATUS_BY_ORDER_STATUS = {"F": "COMPLETED", "O": "CURRENT"}  # anything else: PLANNING


def entry_id(user: Column, media: Column) -> Column:
    """The id of an entry, made of its keys: it need not move or be stored beside them."""
    return F.shiftleft(user.cast("long"), ENTRY_ID_SHIFT) + media


def entry_facts(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per (customer, part): the flat entry attributes."""
    # Days and a rank of the status move, neither timestamps nor text. Ranks follow the
    # order of the texts, so the greatest is that of the lexically largest status.
    status = F.col("o_orderstatus")
    rank = (F.when(status > "O", F.lit(4)).when(status == "O", F.lit(3)).when(status > "F", F.lit(2))
            .when(status == "F", F.lit(1)).when(status.isNotNull(), F.lit(0)).cast("byte"))
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity", F.to_date("l_shipdate").alias("ship_day"))
    od = orders.select("o_orderkey", "o_custkey", rank.alias("status_rank"), F.to_date("o_orderdate").alias("order_day"))
    g = (li.join(od, li.l_orderkey == od.o_orderkey)
         .groupBy("o_custkey", "l_partkey")
         .agg(F.max("l_quantity").alias("max_qty"),
              F.count(F.lit(1)).alias("n_lines"),
              F.max("status_rank").alias("status_rank"),
              F.min("order_day").alias("started"),
              F.max("ship_day").alias("completed")))
    status = (F.when(F.col("status_rank") == 3, F.lit(STATUS_BY_ORDER_STATUS["O"]))
              .when(F.col("status_rank") == 1, F.lit(STATUS_BY_ORDER_STATUS["F"]))
              .otherwise(F.lit("PLANNING")))
    return g.select(
        entry_id(F.col("o_custkey"), F.col("l_partkey")).alias("entry_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("media_id"),
        (F.col("max_qty").cast("int") % 11).cast("double").alias("score"),
        F.col("n_lines").alias("progress"),
        status.alias("status"),
        "started",
        "completed",
    )


def _parts(d: Column, day: Column | None = None) -> Column:
    return F.struct(F.year(d).cast("long").alias("year"), F.month(d).cast("long").alias("month"),
                    (F.dayofmonth(d).cast("long") if day is None else day).alias("day"))


# What a media is made of.
PART_COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size")


def media_struct(part: DataFrame) -> DataFrame:
    """``(media_id, media)`` from ``part``: the columns that ``media_value`` needs."""
    return part.select(F.col("p_partkey").alias("media_id"), F.struct(*PART_COLUMNS).alias("media"))


def media_value(part: Column) -> Column:
    """The media of one ``part`` row, given as a struct of ``PART_COLUMNS``."""
    key, name, brand, kind, size = (part[c] for c in PART_COLUMNS)
    first_word = F.split_part(name, F.lit(" "), F.lit(1))
    second_word = F.split_part(name, F.lit(" "), F.lit(2))
    no_arrays = size % 10 == 0

    def tag(text: Column) -> Column:
        return F.struct(F.lit("item").alias("category"), F.lit(None).cast("string").alias("description"),
                        text.alias("name"), size.cast("long").alias("rank"))

    # a media without a size has the last season, as it always had
    season = F.element_at(F.array(*[F.lit(s) for s in SEASONS]), F.coalesce((size % 4 + 1).cast("int"), F.lit(-1)))
    season_year = (F.lit(2000) + size % 25).cast("long")
    genres = F.when(no_arrays, F.array().cast("array<string>")).otherwise(F.array(kind, first_word))
    tags = F.when(no_arrays, F.array().cast(schemas.MEDIA["tags"].dataType)).otherwise(
        F.array(tag(second_word), tag(brand), tag(F.concat(F.lit("size_"), (size % 5).cast("string")))))
    synonyms = F.when((size % 2 == 0) & ~no_arrays, F.array(name)).otherwise(F.array().cast("array<string>"))
    null_long = F.lit(None).cast("long")
    return F.struct(
        key.cast("long").alias("id"),
        genres.alias("genres"),
        name.alias("description"),
        F.struct(name.alias("english"),
                 F.when(size % 7 == 0, F.lit(None).cast("string")).otherwise(F.upper(name)).alias("native"),
                 F.concat_ws(" ", brand, name).alias("romaji")).alias("title"),
        F.struct(F.concat(F.lit("cover/"), key.cast("string")).alias("extraLarge"),
                 F.lit(None).cast("string").alias("large")).alias("coverImage"),
        F.lit("ANIME").alias("type"),
        F.lit("FINISHED").alias("status"),
        kind.alias("format"),
        season.alias("season"),
        season_year.alias("seasonYear"),
        (size + 40).cast("long").alias("averageScore"),
        (size + 38).cast("long").alias("meanScore"),
        (key % 1000).cast("long").alias("popularity"),
        (key % 10).cast("long").alias("trending"),
        (key % 100).cast("long").alias("favourites"),
        F.when(size % 5 == 0, null_long).otherwise(size.cast("long")).alias("episodes"),
        tags.alias("tags"),
        synonyms.alias("synonyms"),
        F.lit("ORIGINAL").alias("source"),
        F.lit(None).cast("string").alias("bannerImage"),
        F.concat(F.lit("media/"), key.cast("string")).alias("siteUrl"),
        F.struct(season_year.alias("year"), (size % 12 + 1).cast("long").alias("month"),
                 (size % 28 + 1).cast("long").alias("day")).alias("startDate"),
        F.struct(null_long.alias("year"), null_long.alias("month"), null_long.alias("day")).alias("endDate"),
        F.lit("{}").alias("stats"),
        F.lit("[]").alias("rankings"),
    )


def user_struct(customer: DataFrame) -> DataFrame:
    """``(user_id, user)`` from ``customer``."""
    key = F.col("c_custkey")
    user = F.struct(
        key.alias("id"),
        F.col("c_name").alias("name"),
        F.struct(F.lit(None).cast("string").alias("extraLarge"),
                 F.concat(F.lit("img/"), key.cast("string")).alias("large")).alias("avatar"),
        F.col("c_mktsegment").alias("bannerImage"),
        F.concat(F.lit("user/"), key.cast("string")).alias("siteUrl"),
        F.to_json(F.struct(F.col("c_nationkey").alias("nation"))).alias("statistics"),
    )
    return customer.select(key.alias("user_id"), user.cast(schemas.USER).alias("user"))


# What an entry is made of, besides its media, its list's status and its keys (those of its user and media).
ENTRY_COLUMNS = ("progress", "score", "started", "completed")


def entry_struct(facts: DataFrame, media: DataFrame) -> DataFrame:
    """``(user_id, status, entry)``: the columns that ``entry_value`` needs, those of the media among them."""
    return facts.join(media, "media_id").select(
        "user_id", "status", F.struct(*ENTRY_COLUMNS, *(F.col("media")[c].alias(c) for c in PART_COLUMNS)).alias("entry"),
        *(c for c in facts.columns if c == "chunk"))


def entry_value(e: Column, user: Column, status: Column) -> Column:
    """An entry with its media embedded, from the ``entry`` of ``entry_struct``."""
    media = e["p_partkey"].cast("long")
    key = entry_id(user, media)
    started_day = F.when(key % 10 == 0, F.lit(None).cast("long")).otherwise(
        F.dayofmonth(e["started"]).cast("long"))
    completed_day = F.when(status == "COMPLETED", F.dayofmonth(e["completed"]).cast("long"))
    return F.struct(
        key.alias("id"),
        e["progress"].alias("progress"),
        e["score"].alias("score"),
        status.alias("status"),
        media.alias("mediaId"),
        user.cast("long").alias("userId"),
        _parts(e["started"], started_day).alias("startedAt"),
        _parts(e["completed"], completed_day).alias("completedAt"),
        media_value(e).alias("media"),
    )


def list_entries(one: Column) -> Column:
    """The entries of one of a document's lists (``_gathered``)."""
    return F.transform(one["entries"], lambda e: entry_value(e, F.col("user_id"), one["status"]))


def build_documents(spark: SparkSession, sf_dir: str, max_entries: int = DEFAULT_MAX_ENTRIES,
                    run_id: str = FIXTURE_RUN_ID, staging_path: str | None = None) -> DataFrame:
    """Documents ``(run_id, doc_id, data)`` derived from the driver tables.

    ``staging_path`` (a folder in the shared checkpoint area) writes the entry
    facts once and reads them back: the nesting step uses them twice (per-user
    sizes and the entries themselves), and without the written table Spark
    plans the ``lineitem`` x ``orders`` join and aggregate twice. Their number
    is known then and sets that of the tasks.
    """
    entries, many, tasks = _numbered_entries(spark, sf_dir, max_entries, staging_path)
    users = user_documents(user_struct(read_table(spark, sf_dir, "customer")), many)
    return nest_documents(entries, users, run_id, tasks)


def _numbered_entries(spark: SparkSession, sf_dir: str, max_entries: int,
                      staging_path: str | None) -> tuple[DataFrame, DataFrame, int | None]:
    """``entry_struct`` of the numbered entry facts, the users of several documents, and ``document_tasks``."""
    facts = entry_facts(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders"))
    tasks = None
    if staging_path:
        with shuffles_for(spark, line_count(spark, sf_dir)):
            facts.drop("entry_id").write.mode("overwrite").parquet(staging_path, compression="zstd")
        facts = spark.read.parquet(staging_path)
        tasks = document_tasks(spark, facts.count())
    many = document_counts(facts, max_entries)
    if staging_path:  # few, so the facts need not move to them: the size of the written table tells
        many.write.mode("overwrite").parquet(f"{staging_path}-many", compression="zstd")
        many = spark.read.parquet(f"{staging_path}-many")
    return entry_struct(_numbered(facts, many), media_struct(read_table(spark, sf_dir, "part"))), many, tasks


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """Rows that the widest shuffle of the derivation moves at most; counted from the files' footers."""
    return read_table(spark, sf_dir, "lineitem").count()


def document_tasks(spark: SparkSession, n_entries: int) -> int | None:
    """How many tasks make the documents of ``n_entries``; None if that may be left to the session.

    Partitions that Spark puts together by their compressed bytes hold a few million
    entries, whose lists a task cannot gather without spilling.
    """
    tasks = -(-n_entries // ENTRIES_PER_TASK)
    own = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return tasks if tasks > own else None


def document_counts(facts: DataFrame, max_entries: int) -> DataFrame:
    """``(many_user, n_chunks)``: users with more entries than one document holds."""
    return (facts.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_user")).where(F.col("n_user") > max_entries)
            .select(F.col("user_id").alias("many_user"),
                    F.ceil(F.col("n_user") / F.lit(max_entries)).cast("long").alias("n_chunks")))


def _numbered(facts: DataFrame, many: DataFrame) -> DataFrame:
    n_chunks = F.coalesce(F.col("n_chunks"), F.lit(1).cast("long"))
    key = F.col("entry_id") if "entry_id" in facts.columns else entry_id(F.col("user_id"), F.col("media_id"))
    return (facts.join(many, F.col("user_id") == F.col("many_user"), "left")
            .withColumn("chunk", F.pmod(F.xxhash64(key), n_chunks)).drop("n_chunks", "many_user"))


def numbered(facts: DataFrame, max_entries: int = DEFAULT_MAX_ENTRIES) -> DataFrame:
    """Entry facts with the number of their document, ``chunk``: ``ceil(n / max_entries)`` documents a user.

    Only users with more entries than one document holds are joined, to the
    narrow facts: they are few, and a heavy user's rows may be split there, as
    nothing is grouped by user afterwards.
    """
    return _numbered(facts, document_counts(facts, max_entries))


def user_documents(users: DataFrame, many: DataFrame) -> DataFrame:
    """``users`` with ``chunk``: a row for each document a user may have, so that documents need not move to their user."""
    last = F.coalesce(F.col("n_chunks"), F.lit(1).cast("long")) - 1
    return (users.join(many, F.col("user_id") == F.col("many_user"), "left")
            .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("n_chunks", "many_user"))


def _gathered(entries: DataFrame, users: DataFrame, tasks: int | None = None) -> DataFrame:
    """``(user_id, chunk, lists, user)``: a document's narrow entries by status, with its user.

    One exchange on the document, to ``tasks`` if given, serves the only grouping, so a
    heavy user's documents are built in different tasks and no list is gathered twice;
    users that come with their chunks (``user_documents``) are joined there without another.
    """
    dealt = entries.repartition(*([tasks] if tasks else []), "user_id", "chunk")
    docs = dealt.groupBy("user_id", "chunk").agg(F.collect_list(F.struct("status", "entry")).alias("rows"))

    def one_list(status: Column) -> Column:
        own = F.filter("rows", lambda r: r["status"].eqNullSafe(status))
        return F.struct(status.alias("status"), F.transform(own, lambda r: r["entry"]).alias("entries"))

    lists = F.transform(F.array_distinct(F.col("rows.status")), one_list).alias("lists")
    keys = [c for c in ("user_id", "chunk") if c in users.columns]
    return docs.join(users, keys).select("user_id", "chunk", lists, "user")


def nest_documents(entries: DataFrame, users: DataFrame, run_id: str = FIXTURE_RUN_ID,
                   tasks: int | None = None) -> DataFrame:
    """Nest numbered ``(user_id, chunk, status, entry)`` rows into bounded documents."""
    def nested(one: Column) -> Column:
        return F.struct(one["status"].alias("name"), one["status"].alias("status"),
                        F.sort_array(list_entries(one)).alias("entries"))

    return _gathered(entries, users, tasks).select(
        F.lit(run_id).alias("run_id"),
        (F.shiftleft(F.col("user_id"), CHUNK_BITS) + F.col("chunk")).alias("doc_id"),
        F.struct(F.struct(F.sort_array(F.transform("lists", nested)).alias("lists")).alias("MediaListCollection"),
                 F.col("user").alias("User")).alias("data"),
    )


# ---------------------------------------------------------------- dirty variant
# The dirty rules are chosen by ``entry id % 97`` (FIXTURES.md section 4):
#   1 score n + 0.5         2 key "progress" missing     3 "progress": null
#   4 startedAt 2023-02-30  5 startedAt month 0          6 score as text "n"
#   7 coverImage with "large" only
# With ``faults`` also values that no cast takes:
#   8 score "eight"         9 progress [3]               10 media episodes "twelve"
DIRTY_MODULUS = 97
# With ``document_faults`` also, by ``user id % 23``:
#   1 a line cut short      2 no "User"                  3 entries without "media"
#   4 lists whose name is null
DOCUMENT_FAULT_MODULUS = 23


def dirty_entry_json(e: Column, faults: bool = False) -> Column:
    """The JSON text of an entry (``entry_value``) carrying the dirty rules.

    Members of more than one type (``progress``, ``score``) and those that are
    JSON text already (``stats``, ``rankings``) are spliced around the others.
    """
    r = e["id"] % DIRTY_MODULUS
    null = F.lit("null")
    whole = e["score"].cast("long").cast("string")
    score = (F.when(r == 1, (e["score"] + F.lit(0.5)).cast("string"))
             .when(r == 6, F.concat(F.lit('"'), whole, F.lit('"')))
             .otherwise(whole))
    progress = F.when(r == 3, null).otherwise(e["progress"].cast("string"))
    if faults:
        score = F.when(r == 8, F.lit('"eight"')).otherwise(score)
        progress = F.when(r == 9, F.lit("[3]")).otherwise(progress)
    progress = F.when(r == 2, F.lit("")).otherwise(F.concat(F.lit(',"progress":'), F.coalesce(progress, null)))
    started = (F.when(r == 4, F.struct(F.lit(2023).cast("long").alias("year"), F.lit(2).cast("long").alias("month"),
                                       F.lit(30).cast("long").alias("day")))
               .when(r == 5, F.struct(e["startedAt"]["year"].alias("year"), F.lit(0).cast("long").alias("month"),
                                      e["startedAt"]["day"].alias("day")))
               .otherwise(e["startedAt"]))
    media = e["media"]
    extra_large = media["coverImage"]["extraLarge"]
    cover = F.when(r == 7, F.struct(F.lit(None).cast("string").alias("extraLarge"), extra_large.alias("large"))
                   ).otherwise(media["coverImage"])
    members = [cover.alias(n) if n == "coverImage" else media[n].alias(n)
               for n in schemas.MEDIA.names if n not in ("stats", "rankings")]
    rest = F.to_json(F.struct(e["status"].alias("status"), e["mediaId"].alias("mediaId"), e["userId"].alias("userId"),
                              started.alias("startedAt"), e["completedAt"].alias("completedAt"),
                              F.struct(*members).alias("media")), {"ignoreNullFields": "false"})
    changed = F.when(r == 7, F.regexp_replace(rest, r'"coverImage":\{"extraLarge":null,', '"coverImage":{'))
    if faults:
        changed = changed.when(r == 10, F.regexp_replace(rest, r'"episodes":(null|\d+)', '"episodes":"twelve"'))
    inner = F.transform(F.array(changed.otherwise(rest)), lambda t: F.substring(t, F.lit(2), F.length(t) - 3))[0]
    return F.concat(F.lit('{"id":'), F.coalesce(e["id"].cast("string"), null), progress,
                    F.lit(',"score":'), F.coalesce(score, null), F.lit(","), inner,
                    F.lit(',"stats":'), media["stats"], F.lit(',"rankings":'), media["rankings"], F.lit("}}"))


def user_json(customer: DataFrame) -> DataFrame:
    """``(user_id, user)`` as JSON text; the avatar has only a ``large`` key."""
    key = F.col("c_custkey")
    user = F.struct(
        key.alias("id"), F.col("c_name").alias("name"),
        F.struct(F.concat(F.lit("img/"), key.cast("string")).alias("large")).alias("avatar"),
        F.col("c_mktsegment").alias("bannerImage"),
        F.concat(F.lit("user/"), key.cast("string")).alias("siteUrl"),
        F.to_json(F.struct(F.col("c_nationkey").alias("nation"))).alias("statistics"),
    )
    js = F.to_json(user.withField("statistics", F.parse_json(user["statistics"])), {"ignoreNullFields": "false"})
    return customer.select(key.alias("user_id"), js.alias("user"))


def build_dirty_documents_text(spark: SparkSession, sf_dir: str, max_entries: int = DEFAULT_MAX_ENTRIES,
                               run_id: str = FIXTURE_RUN_ID, faults: bool = False,
                               document_faults: bool = False, staging_path: str | None = None) -> DataFrame:
    """``(run_id, value)``: one JSON document per line, with the dirty rules applied."""
    entries, many, tasks = _numbered_entries(spark, sf_dir, max_entries, staging_path)
    users = user_documents(user_json(read_table(spark, sf_dir, "customer")), many)
    rule = F.col("user_id") % DOCUMENT_FAULT_MODULUS if document_faults else F.lit(0)

    # The entry and user objects are already JSON text: the list and document
    # text is spliced around them (no re-parse and re-render per entry).
    def list_text(one: Column) -> Column:
        head = F.to_json(F.struct(F.when(rule != 4, one["status"]).alias("name"), one["status"].alias("status")),
                         {"ignoreNullFields": "false"})
        texts = F.transform(list_entries(one), lambda e: dirty_entry_json(e, faults))
        return F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"entries":['),
                        F.array_join(texts, ","), F.lit("]}"))

    doc_id = (F.shiftleft(F.col("user_id"), CHUNK_BITS) + F.col("chunk")).cast("string")
    lists = F.array_join(F.transform("lists", list_text), ",")
    listed = F.when(rule == 3, F.regexp_replace(lists, r'"media":\{', '"medium":{')).otherwise(lists)
    member = F.when(rule == 2, F.lit("")).otherwise(F.concat(F.lit(',"User":'), F.col("user")))
    value = F.concat(F.lit('{"doc_id":'), doc_id, F.lit(',"data":{"MediaListCollection":{"lists":['),
                     listed, F.lit("]}"), member, F.when(rule == 1, F.lit("}")).otherwise(F.lit("}}")))
    return _gathered(entries, users, tasks).select(F.lit(run_id).alias("run_id"), value.alias("value"))


def land_text(docs_text: DataFrame, root: str) -> None:
    """Land ``(run_id, value)`` JSON lines under run folders."""
    from .landing import GZIP_LEVEL, MAX_DOCUMENTS_PER_FILE
    (docs_text.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "gzip").option("maxRecordsPerFile", MAX_DOCUMENTS_PER_FILE).options(**GZIP_LEVEL)
     .partitionBy("run_id").text(root))
