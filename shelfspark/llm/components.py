"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import stored


def _to_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    # the least neighbours are a table of their own: both sides of the join are
    # plain shuffles, so adaptive execution may split a node with many edges
    return edges.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) long -> (id, component): each node with a smaller one and its least node.

    Nodes that are the least of their component have no row. An empty input
    gives no rows. Each step is written to the shared folder; the loop ends when
    a step leaves the edges as they are (about the logarithm of the diameter).
    """
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .filter("u != v").distinct(), "edges")
    before, earlier = None, now
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        # equal sums only say that it is worth comparing the edges themselves
        if state[0] == 0 or state == before and now.join(earlier, ["u", "v"], "left_anti").isEmpty():
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before, earlier = state, now
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m"))
                       .select("u", F.least("u", "m").alias("m")), "least")
        large = stored(_to_least(both.filter("v > u"), least)
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = _to_least(large, least)
        now = stored(least.withColumnRenamed("m", "v")
                     .unionByName(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                     .distinct(), "edges")
