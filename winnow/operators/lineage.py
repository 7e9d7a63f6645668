"""Lineage closure over parent pointers (K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ancestors(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """(child, ancestor, depth) for every ancestor reachable through
    ``parent``, with its smallest depth, by path doubling: each round joins the paths
    found last, of half to all of the reach so far, with all paths, so a chain of depth d
    takes about log2(d) rounds.  Every round is a reliable checkpoint.  The shortest path to an
    ancestor at depth d splits into a path of the last round and a shorter one, so a round finds
    every pair up to twice the reach, at its smallest depth; the loop ends when a round finds none,
    whatever the depth.  A row in a cycle is its own ancestor (see ``cycles``)."""
    c, p = F.col(child).alias("_c"), F.col(parent).alias("_p")
    found = edges.filter(F.col(parent).isNotNull() & F.col(child).isNotNull()).select(c, p).distinct().withColumn("_d", F.lit(1).cast("long"))
    found = found.checkpoint(eager=True)
    reach = 1
    while True:
        # paths of exactly the reach, prolonged by any path found: depths up to twice the reach
        ends = found.filter(F.col("_d") == reach).select(F.col("_c").alias("_from"), F.col("_p").alias("_mid"), F.col("_d").alias("_far"))
        longer = ends.join(found, ends["_mid"] == found["_c"]).select(F.col("_from").alias("_c"), "_p", (F.col("_far") + F.col("_d")).alias("_d"))
        both = found.unionByName(longer).groupBy("_c", "_p").agg(F.min("_d").alias("_d")).checkpoint(eager=True)
        if both.filter(F.col("_d") > reach).isEmpty():
            return both.select(F.col("_c").alias(child), F.col("_p").alias("ancestor"), F.col("_d").cast("int").alias("depth"))
        found, reach = both, 2 * reach


def cycles(closure: DataFrame, child: str) -> DataFrame:
    """Rows that are their own ancestor, with the length of their cycle."""
    return closure.filter(F.col(child) == F.col("ancestor")).select(child, F.col("depth").alias("length"))
