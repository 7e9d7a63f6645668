"""Vector expressions: embedding check (B11), cosine distance, normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def embedding_ok(v, dim: int) -> Column:
    """Exact dimension, every component present and finite."""
    x = _c(v)
    return (
        x.isNotNull()
        & (F.size(x) == dim)
        & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    )


def embedding_problem(v, dim: int) -> Column:
    """Why an embedding is unusable, or NULL."""
    x = _c(v)
    return (
        F.when(x.isNull(), F.lit("missing"))
        .when(F.size(x) != dim, F.lit("wrong_dimension"))
        .when(F.exists(x, lambda e: e.isNull()), F.lit("null_component"))
        .when(F.exists(x, lambda e: F.isnan(e) | (F.abs(e) == F.lit(float("inf")))), F.lit("non_finite"))
    )


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, z: s + z)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine_distance(a, b) -> Column:
    """1 - cos(a, b), the similarity clipped to [-1, 1]; NaN when a norm is zero (as pgvector)."""
    scale = norm(a) * norm(b)
    cos = F.greatest(F.least(dot(a, b) / F.nullif(scale, F.lit(0.0)), F.lit(1.0)), F.lit(-1.0))
    return F.when(scale == 0, F.lit(float("nan"))).otherwise(F.lit(1.0) - cos)
