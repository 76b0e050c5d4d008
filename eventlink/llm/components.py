"""Connected components of an edge table by alternating large and small stars.

Every round rewires each edge towards the smallest neighbour; the rounds end
when the edges form stars.  A hub's edges are never gathered: its smallest
neighbour is a map-side minimum, joined back to the edges, where Spark may
split a hot key.  Each round is a written table, so a lost executor costs one
round at most.

Defined cases: edges with a null end are ignored, as are loops and repeats; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger end ``u`` to the smaller ``v``."""
    return (edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    # e runs from larger to smaller: the larger neighbours of v are its sources
    return (e.select(F.col("v").alias("u"), F.col("u").alias("big")).join(least, "u")
            .select(F.col("big").alias("u"), F.col("m").alias("v")))


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _mark(e: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table."""
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node``, ``root``: every end of an edge and the smallest node it can reach."""
    e = stage(_directed(edges.select(F.col(u).alias("u"), F.col(v).alias("v"))), "edges")
    mark = _mark(e)
    while mark[0]:
        e = stage(_directed(_large_star(e)), "large-star")
        e = stage(_directed(_small_star(e)), "small-star")
        if (now := _mark(e)) == mark:
            break
        mark = now
    members = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
