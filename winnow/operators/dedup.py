"""Exact greedy dedup.

Among rows that passed validation, per (scope, key) the first row in queue
order is accepted unless an accepted sample of the store already holds the
key; all others are ``duplicate_sample`` naming the lowest accepted match.
Equality is transitive, so one pass is the greedy answer.

Plan: the winner and the row count per key are a partial (map-side)
aggregate, so a key that holds a third of all rows shuffles one row per map
task.  Keys with one row need no join.  The winners of the others are
checkpointed, so the join back reads plain shuffles on both sides, which
adaptive execution can split where a key is hot.  Keys are compared
null-safe.  No window over a hot key, nothing through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes


def exact_greedy_dedup(cands: DataFrame, key_cols: Sequence[str], order: Sequence[Column], id_col: str,
                       scope_cols: Sequence[str] = (), accepted: DataFrame | None = None,
                       accepted_id: str | None = None) -> DataFrame:
    """Adds ``dedup_code`` (NULL or duplicate_sample) and ``duplicate_of``.

    ``order``: Columns whose ascending struct order is the queue order
    (negate numeric priorities for descending).  ``accepted``: store rows
    already accepted, with the same scope and key columns and ``accepted_id``.
    """
    keys = list(scope_cols) + list(key_cols)
    order_struct = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.col(id_col).alias("_oid"))
    first = cands.groupBy(*keys).agg(F.min(order_struct).alias("_f"), F.count(F.lit(1)).alias("_n"))
    winners = first.filter("_n > 1").select(*[F.col(k).alias(f"_w_{k}") for k in keys], F.col("_f._oid").alias("_first_id"))
    out = _null_safe_join(cands, winners.checkpoint(eager=True), keys, "_w_")
    if accepted is not None:
        aid = accepted_id or id_col
        prior = accepted.groupBy(*keys).agg(F.min(F.col(aid)).alias("_prior_id"))
        prior = prior.select(*[F.col(k).alias(f"_a_{k}") for k in keys], "_prior_id")
        out = _null_safe_join(out, prior.checkpoint(eager=True), keys, "_a_")
    else:
        out = out.withColumn("_prior_id", F.lit(None).cast(cands.schema[id_col].dataType))
    dup_of = F.coalesce(F.col("_prior_id"), F.when(F.col(id_col) != F.col("_first_id"), F.col("_first_id")))
    return (
        out.withColumn("duplicate_of", dup_of)
        .withColumn("dedup_code", F.when(F.col("duplicate_of").isNotNull(), F.lit(codes.DUPLICATE_SAMPLE)))
        .drop("_first_id", "_prior_id")
    )


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Left join on ``keys`` to ``prefix + key`` columns of ``right``, which go again."""
    on = [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys]
    return left.join(right, on, "left").drop(*[prefix + k for k in keys])
