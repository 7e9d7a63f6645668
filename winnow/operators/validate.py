"""Prediction rules (C2, C3, C4, C9) and decision contracts.

Each rule is an ordered ``CASE WHEN`` chain: the first failing check gives
the failure code, later checks leave nothing.  All are Column expressions,
so they run inside whole-stage codegen next to the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes
from ..functions.text import non_blank

PROBS_TYPE = "array<struct<label:string,probability:double>>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class ClassificationSettings:
    allowed_classes: tuple[str, ...]
    confidence_required: bool = True
    confidence_minimum: float = 0.6
    mode: str = codes.CLASSIFICATION


@dataclass(frozen=True)
class RegressionSettings:
    minimum: float
    maximum: float
    mode: str = codes.REGRESSION


def _kind(df: DataFrame, col: str) -> Column:
    """JSON-like kind of the prediction column: string, number, boolean or other."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.StringType):
        return F.lit("string")
    if isinstance(dt, T.BooleanType):
        return F.lit("boolean")
    if isinstance(dt, (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.DecimalType)):
        return F.lit("number")
    if isinstance(dt, T.VariantType):
        s = F.schema_of_variant(F.col(col))
        return (F.when(s == "STRING", "string").when(s == "BOOLEAN", "boolean")
                .when(s.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"), "number").otherwise("other"))
    return F.lit("other")


def probability_problem(probs, allowed: tuple[str, ...], required: bool) -> Column:
    """NULL when the probability vector is acceptable, else the code."""
    p = _c(probs)
    labels = F.transform(p, lambda x: x["label"])
    total = F.aggregate(p, F.lit(0.0), lambda s, x: s + x["probability"])
    allowed_arr = F.array(*[F.lit(a) for a in allowed]) if allowed else F.array().cast("array<string>")
    same_set = (F.size(F.array_except(labels, allowed_arr)) == 0) & (F.size(F.array_except(allowed_arr, labels)) == 0)
    bad_value = F.exists(p, lambda x: x["probability"].isNull() | F.isnan(x["probability"])
                         | (x["probability"] < 0.0) | (x["probability"] > 1.0))
    return (
        F.when(p.isNull(), F.lit(codes.MISSING_PROBABILITY) if required else F.lit(None).cast("string"))
        .when(F.size(p) == 0, F.lit(codes.INVALID_PROBABILITY))
        .when(F.exists(labels, lambda l: l.isNull()) | (F.size(F.array_distinct(labels)) != F.size(labels)), F.lit(codes.INVALID_PROBABILITY))
        .when(bad_value, F.lit(codes.INVALID_PROBABILITY))
        .when(~same_set, F.lit(codes.INVALID_PROBABILITY))
        .when(F.abs(total - F.lit(1.0)) > F.lit(codes.PROBABILITY_SUM_TOLERANCE), F.lit(codes.INVALID_PROBABILITY))
    )


def classification_verdict(df: DataFrame, s: ClassificationSettings, mode="mode", pipeline_id="pipeline_id",
                           prediction="prediction", probabilities="probabilities") -> DataFrame:
    """Adds ``failure_code`` (NULL = passed) and ``score`` (p(predicted))."""
    kind = _kind(df, prediction)
    pred = F.col(prediction).cast("string")
    conf = F.filter(F.col(probabilities), lambda x: x["label"] == pred)[0]["probability"]
    prob_code = probability_problem(F.col(probabilities), s.allowed_classes, s.confidence_required)
    code = (
        F.when(F.col(mode) != F.lit(s.mode), F.lit(codes.WRONG_PREDICTION_MODE))
        .when(~non_blank(pipeline_id), F.lit(codes.MISSING_PIPELINE_IDENTITY))
        .when(kind != "string", F.lit(codes.WRONG_TYPE))
        .when(~pred.isin(*s.allowed_classes), F.lit(codes.INVALID_CLASS))
        .when(prob_code.isNotNull(), prob_code)
        .when(F.lit(s.confidence_required) & conf.isNotNull() & (conf < F.lit(s.confidence_minimum)), F.lit(codes.CONFIDENCE_ERROR))
    )
    out = df.withColumn("failure_code", code)
    return out.withColumn("score", F.when(F.col("failure_code").isNull(), conf.cast("double")))


def regression_verdict(df: DataFrame, s: RegressionSettings, mode="mode", pipeline_id="pipeline_id",
                       prediction="prediction", probabilities="probabilities") -> DataFrame:
    """C4: numeric not bool -> finite -> no probabilities -> inclusive range."""
    kind = _kind(df, prediction)
    v = F.col(prediction).cast("double") if not isinstance(df.schema[prediction].dataType, T.VariantType) \
        else F.try_variant_get(F.col(prediction), "$", "double")
    probs = F.col(probabilities) if probabilities in df.columns else F.lit(None)
    code = (
        F.when(F.col(mode) != F.lit(s.mode), F.lit(codes.WRONG_PREDICTION_MODE))
        .when(~non_blank(pipeline_id), F.lit(codes.MISSING_PIPELINE_IDENTITY))
        .when((kind != "number") | v.isNull(), F.lit(codes.WRONG_TYPE))
        # NaN first: Spark orders NaN above +Infinity
        .when(F.isnan(v), F.lit(codes.NAN_DETECTED))
        .when(F.abs(v) == F.lit(float("inf")), F.lit(codes.INFINITY_DETECTED))
        .when(probs.isNotNull(), F.lit(codes.INVALID_PROBABILITY))
        .when((v < F.lit(s.minimum)) | (v > F.lit(s.maximum)), F.lit(codes.RANGE_ERROR))
    )
    out = df.withColumn("failure_code", code)
    return out.withColumn("score", F.when(F.col("failure_code").isNull(), v))


def decision_violations(samples: DataFrame, status="status", failure_code="failure_code",
                        failure_reason="failure_reason") -> DataFrame:
    """Rows breaking 'accepted <=> no failure code and no reason'."""
    acc = F.col(status) == codes.ACCEPTED
    clean = F.col(failure_code).isNull() & (F.col(failure_reason).isNull() if failure_reason in samples.columns else F.lit(True))
    return samples.filter((acc & ~clean) | (~acc & F.col(failure_code).isNull()) | ~F.col(status).isin(codes.ACCEPTED, codes.REJECTED))


def task_error_violations(tasks: DataFrame) -> DataFrame:
    """Error evidence all-or-none; a present source_id must be non-blank."""
    cols = [F.col(c).isNull() for c in ("error_type", "error_message", "error_traceback")]
    all_none = cols[0] & cols[1] & cols[2]
    all_some = ~cols[0] & ~cols[1] & ~cols[2]
    bad_source = F.col("source_id").isNotNull() & ~non_blank("source_id")
    return tasks.filter(~(all_none | all_some) | bad_source)


def assert_empty(df: DataFrame, what: str) -> None:
    """Raise when a violations frame has rows (only the first few are fetched)."""
    bad = df.limit(5).collect()
    if bad:
        raise ValueError(f"{what}: {len(bad)}+ violating rows, e.g. {bad[0].asDict()}")
