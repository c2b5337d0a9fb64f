"""Distributed union-find: connected components of a table of links.

Alternating large-star / small-star rounds.  Each round reduces per node
with a map-side combined ``min`` and joins the minimum back, so a node of very
high degree is never gathered in one task; the links are stored in the shared
folder after each round, so lost executors re-read files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import drop_saved, saved


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(low, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of ``links``; ``component`` is the
    smallest node of the component.  Links with a null or equal ends add
    nothing.  The result is a stored table."""
    spark = links.sparkSession
    e = saved(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
              .where("u <> v").distinct(), "links")
    state = None
    while True:
        nxt = saved(_small_star(_large_star(e)), "links")
        drop_saved(spark, e)
        e = nxt
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return out.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
