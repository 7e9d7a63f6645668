"""Connected components over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): ``root`` is the smallest node reachable from ``node``.

    Contraction: every node points at the smallest node of its neighbourhood, the
    edges are rewritten to the nodes pointed at, loops and repeats go, and the next
    round works on what is left.  The smallest node of a component always points at
    itself, so the last node left is the component's minimum.  The rounds end when no
    edge is left; there is no cap.  Each round is written to the shared folder.  A hub
    is pre-aggregated (``min`` per node) and its edges are read from a written table,
    so that the join back to the hub can be split.  No edges give an empty table;
    edges with a null end and loops link nothing.
    """
    cur = written(_clean(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))), "edges")
    pointers = []
    while not cur.isEmpty():
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("m"))
        up = written(up.select(F.col("a").alias("node"), F.least("a", "m").alias("up")), "pointers")
        pointers.append(up)
        left = up.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        right = up.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        moved = cur.join(left, "a").join(right, "b").select(F.col("ua").alias("a"), F.col("ub").alias("b"))
        cur = written(_clean(moved), "edges")
    if not pointers:
        return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = pointers[0].select("node", F.col("up").alias("root"))
    for up in pointers[1:]:
        step = up.select(F.col("node").alias("root"), "up")
        out = out.join(step, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return written(out, "components")


def _clean(edges: DataFrame) -> DataFrame:
    ordered = edges.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.distinct()
