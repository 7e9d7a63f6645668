"""Reports over verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes


def rejection_stats(verdicts: DataFrame, dims: Sequence[str]) -> DataFrame:
    """K1: rejected counts by ``dims`` with ROLLUP subtotals and share of all
    rejections.  The grand total is a one-row aggregate (broadcast)."""
    rej = verdicts.filter(F.col("status") == codes.REJECTED)
    g = rej.rollup(*dims).agg(F.count(F.lit(1)).alias("n_rejected"), F.grouping_id().alias("_gid"))
    full = (1 << len(dims)) - 1
    # the grand total is the rollup's own top row; the rolled-up frame has
    # one row per (dims) combination of a fixed code vocabulary, so this
    # window runs over a small, bounded frame
    total = F.max(F.when(F.col("_gid") == full, F.col("n_rejected"))).over(Window.partitionBy(F.lit(0)))
    return g.select(*dims, "n_rejected", F.round(F.col("n_rejected") / total, 6).alias("share"))


def export_summary(samples: DataFrame, dims: Sequence[str] = ("branch", "dataset_id")) -> DataFrame:
    """accepted/rejected count per branch and dataset (pivot on a fixed list)."""
    return samples.groupBy(*dims).pivot("status", [codes.ACCEPTED, codes.REJECTED]).agg(F.count(F.lit(1))).fillna(0)


def counts_by_pattern(tables: dict[str, tuple[DataFrame, str]], pattern: str) -> DataFrame:
    """(table, n) rows of each table whose id matches a LIKE pattern; a count per task, nothing else moves."""
    parts = [df.filter(F.col(c).cast("string").like(pattern)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table"), "n")
             for t, (df, c) in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
