"""Fixed schemas: the raw document envelope and the tables built from it.

The raw schema is fixed (no inference in production). Opaque JSON members
(``stats``, ``rankings``, ``statistics``) are STRING columns holding JSON
text; Spark's JSON reader keeps the nested text verbatim for a STRING field.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DateType, DoubleType, LongType,
                               StringType, StructField, StructType)


def _s(*fields):
    return StructType(list(fields))


def _f(name, dtype):
    return StructField(name, dtype, True)


STR = StringType()
LONG = LongType()

DATE_PARTS = _s(_f("year", LONG), _f("month", LONG), _f("day", LONG))
TITLE = _s(_f("english", STR), _f("native", STR), _f("romaji", STR))
TAG = _s(_f("category", STR), _f("description", STR), _f("name", STR), _f("rank", LONG))
IMAGE = _s(_f("extraLarge", STR), _f("large", STR))

MEDIA = _s(
    _f("id", LONG),
    _f("genres", ArrayType(STR)),
    _f("description", STR),
    _f("title", TITLE),
    _f("coverImage", IMAGE),
    _f("type", STR),
    _f("status", STR),
    _f("format", STR),
    _f("season", STR),
    _f("seasonYear", LONG),
    _f("averageScore", LONG),
    _f("meanScore", LONG),
    _f("popularity", LONG),
    _f("trending", LONG),
    _f("favourites", LONG),
    _f("episodes", LONG),
    _f("tags", ArrayType(TAG)),
    _f("synonyms", ArrayType(STR)),
    _f("source", STR),
    _f("bannerImage", STR),
    _f("siteUrl", STR),
    _f("startDate", DATE_PARTS),
    _f("endDate", DATE_PARTS),
    _f("stats", STR),
    _f("rankings", STR),
)

ENTRY = _s(
    _f("id", LONG),
    _f("progress", LONG),
    _f("score", DoubleType()),
    _f("status", STR),
    _f("mediaId", LONG),
    _f("userId", LONG),
    _f("startedAt", DATE_PARTS),
    _f("completedAt", DATE_PARTS),
    _f("media", MEDIA),
)

MEDIA_LIST = _s(_f("name", STR), _f("status", STR), _f("entries", ArrayType(ENTRY)))

USER = _s(
    _f("id", LONG),
    _f("name", STR),
    _f("avatar", IMAGE),
    _f("bannerImage", STR),
    _f("siteUrl", STR),
    _f("statistics", STR),
)

DATA = _s(
    _f("MediaListCollection", _s(_f("lists", ArrayType(MEDIA_LIST)))),
    _f("User", USER),
)

# One landed document: ``{"doc_id": …, "data": {…}}``; ``run_id`` comes from
# the run folder (``run_id=<id>/``), so it is a partition column on read.
RAW_DOCUMENT = _s(_f("doc_id", LONG), _f("data", DATA))

# JSON members whose value is opaque JSON text.
OPAQUE_JSON_FIELDS = ("stats", "rankings", "statistics")

# Output column lists (names and order) of the four tables.
FACT_COLUMNS = [
    "id", "user_id", "media_id", "average_score", "mean_score", "popularity",
    "trending", "favourites", "progress", "episodes", "score", "watch_status",
    "started_at", "completed_at", "stats", "rankings",
]

MEDIA_COLUMNS = [
    "id", "genres", "description", "cover_image", "type", "tags", "episodes",
    "format", "season", "season_year", "start_date", "end_date", "synonyms",
    "title", "source", "banner_image", "site_url", "status",
]

USER_COLUMNS = ["id", "name", "avatar", "banner_image", "site_url", "statistics"]

MART_COLUMNS = [
    "user_id", "user_name", "media_id", "english_title", "native_title",
    "romaji_title", "description", "synonym", "genre", "tag", "source",
    "episodes", "season", "season_year", "start_date", "end_date", "status",
    "progress", "watch_status", "score", "average_score", "mean_score",
    "popularity", "trending", "favourites",
]

DATE = DateType()


def _keep(struct: StructType, names: set[str]) -> StructType:
    return StructType([f for f in struct.fields if f.name in names])


# The entry and media members the fact model reads.
FACT_ENTRY_FIELDS = {"id", "progress", "score", "status", "userId", "startedAt", "completedAt", "media"}
FACT_MEDIA_FIELDS = {"id", "averageScore", "meanScore", "popularity", "trending", "favourites",
                     "episodes", "stats", "rankings"}


def raw_schema_for(entry_fields: set[str], media_fields: set[str],
                   user_fields: set[str] = frozenset()) -> StructType:
    """The raw-document schema narrowed to some entry and media members.

    Parquet reads only the leaves a read schema names, including inside the
    ``array<array<struct>>`` of entries where column pruning cannot reach.
    """
    media = _keep(MEDIA, media_fields)
    entry = StructType([f if f.name != "media" else StructField("media", media, True)
                        for f in ENTRY.fields if f.name in entry_fields])
    lists = ArrayType(StructType([StructField("entries", ArrayType(entry), True)]))
    members = [_f("MediaListCollection", _s(_f("lists", lists)))]
    if user_fields:
        members.append(_f("User", _keep(USER, set(user_fields))))
    return _s(_f("doc_id", LONG), _f("data", _s(*members)), _f("run_id", STR))


FACT_RAW_SCHEMA = raw_schema_for(FACT_ENTRY_FIELDS, FACT_MEDIA_FIELDS)
# Finding a media's latest copy needs the ids only, its row the media members.
MEDIA_KEYS_RAW_SCHEMA = raw_schema_for({"id", "media"}, {"id"})
MEDIA_RAW_SCHEMA = raw_schema_for({"id", "media"}, set(MEDIA.names))


def _numbers(kind):
    """``kind`` with its numbers only, those of ``UNCAST_MEMBERS`` left out; None without any."""
    if isinstance(kind, StructType):
        kept = [(f.name, _numbers(f.dataType)) for f in kind if f.name not in UNCAST_MEMBERS]
        fields = [_f(name, k) for name, k in kept if k is not None]
        return StructType(fields) if fields else None
    if isinstance(kind, ArrayType):
        inner = _numbers(kind.elementType)
        return None if inner is None else ArrayType(inner)
    return kind if isinstance(kind, (LongType, DoubleType)) else None


# Members whose numbers the models do not cast.
UNCAST_MEMBERS = ("tags",)
# Finding the numbers that cannot be cast needs the numbers only.
NUMBERS_RAW_SCHEMA = _numbers(RAW_DOCUMENT)
# Counting fan-out events needs the document and entry structure only.
EVENT_COUNT_RAW_SCHEMA = raw_schema_for({"id"}, set(), {"id"})
