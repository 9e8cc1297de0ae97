"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_table


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; component is the smallest
    node reachable.  Links are unordered pairs; null ends and self links are
    ignored, repeated links count once, an empty table gives an empty result.

    Each star step is one aggregate (the smallest neighbour, combined before the
    shuffle) and one join; the link table only gets smaller and is written to the
    shared folder after each round, which cuts the lineage.
    """
    e = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where("u is not null and v is not null and u <> v").distinct())
    state = write_table(e, "links")
    before = None
    while True:
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour of u hangs on u's smallest neighbour
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: u and its smaller neighbours hang on the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        state = write_table(small, "links")
        # the order-free digest tells whether the round changed anything
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
