"""Hand-written single-document inputs (same shape as the landed documents)."""

import copy
import json

VALID = {
    "doc_id": 1,
    "data": {
        "MediaListCollection": {
            "lists": [{
                "name": "Watching",
                "status": "CURRENT",
                "entries": [{
                    "id": 11,
                    "progress": 3,
                    "score": 8,
                    "status": "CURRENT",
                    "mediaId": 500,
                    "userId": 7,
                    "media": {
                        "id": 500,
                        "genres": ["Drama", "Comedy"],
                        "description": "a show",
                        "title": {"english": "Show", "native": "SHOW", "romaji": "Sho"},
                        "coverImage": {"extraLarge": "xl.png"},
                        "type": "ANIME",
                        "status": "FINISHED",
                        "averageScore": 72,
                        "meanScore": 70,
                        "popularity": 900,
                        "trending": 1,
                        "favourites": 12,
                        "episodes": 24,
                        "tags": [{"category": "c", "description": "d", "name": "school", "rank": 90},
                                 {"category": "c", "description": None, "name": "band", "rank": 60},
                                 {"category": "c", "description": None, "name": "city", "rank": 10}],
                        "format": "TV",
                        "season": "SPRING",
                        "seasonYear": 2020,
                        "synonyms": ["alias"],
                        "source": "MANGA",
                        "bannerImage": "banner.png",
                        "siteUrl": "site/500",
                        "stats": {},
                        "rankings": [],
                    },
                }],
            }]
        },
        "User": {
            "id": 7,
            "name": "viewer",
            "avatar": {"large": "avatar.png"},
            "bannerImage": "ub.png",
            "siteUrl": "user/7",
            "statistics": {},
        },
    },
}


def variant(**changes):
    d = copy.deepcopy(VALID)
    for path, value in changes.items():
        node = d
        keys = path.split("__")
        for k in keys[:-1]:
            node = node[int(k)] if k.isdigit() else node[k]
        last = keys[-1]
        if value is DELETE:
            del node[last]
        else:
            node[last] = value
    return d


DELETE = object()


def entry_path(field):
    return f"data__MediaListCollection__lists__0__entries__0__{field}"


def media_path(field):
    return entry_path(f"media__{field}")


def text_frame(spark, *docs):
    return spark.createDataFrame([("t", json.dumps(d)) for d in docs], "run_id string, value string")


def pairs_of_mart(mart):
    """(media, score, tag, genre) of a mart: every tag of a media item and score with every genre.

    The join it stands for is by (media, score), so rows without a score meet nothing.
    """
    from pyspark.sql import functions as F
    of = mart.where(F.col("score").isNotNull()).groupBy("media_id", "score").agg(F.collect_set("tag").alias("tags"), F.collect_set("genre").alias("genres"))
    return (of.select("media_id", "score", F.explode("tags").alias("tag"), "genres")
            .select("media_id", "score", "tag", F.explode("genres").alias("genre")))
