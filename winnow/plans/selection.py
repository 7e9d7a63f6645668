"""ML-style selection queries over ``events`` and ``labels``/``documents``
(G1, F2, C2, C3, C4, E1, H6, K1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..operators.dedup import exact_greedy_dedup
from ..operators.validate import (ClassificationSettings, RegressionSettings, classification_verdict,
                                  regression_verdict)
from ..session import read_table, spread
from .registry import query

REGRESSION = RegressionSettings(minimum=10.0, maximum=400.0)
CLASSES = ClassificationSettings(allowed_classes=("high", "low"), confidence_required=True, confidence_minimum=0.6)


def _status(code_col: str = "failure_code"):
    return F.when(F.col(code_col).isNull(), F.lit(codes.ACCEPTED)).otherwise(F.lit(codes.REJECTED))


@query("exact_dedup_events", """
WITH f AS (
  SELECT event_id, user_id, event_type,
         first_value(event_id) OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS first_id
  FROM events)
SELECT event_id, user_id, event_type,
       CASE WHEN event_id = first_id THEN 'accepted' ELSE 'rejected' END AS status,
       CASE WHEN event_id = first_id THEN NULL ELSE 'duplicate_sample' END AS failure_code,
       CASE WHEN event_id = first_id THEN NULL ELSE first_id END AS duplicate_of
FROM f
""")
def exact_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    out = exact_greedy_dedup(ev, ["user_id", "event_type"], [-F.col("value")], "event_id")
    return out.select("event_id", "user_id", "event_type",
                      _status("dedup_code").alias("status"),
                      F.col("dedup_code").alias("failure_code"), "duplicate_of")


def regression_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 on value as the prediction, then G1 on the survivors."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value",
        F.lit(codes.REGRESSION).alias("mode"), F.col("event_type").alias("pipeline_id"),
        F.col("value").alias("prediction"))
    judged = regression_verdict(ev, REGRESSION)
    passed = judged.filter(F.col("failure_code").isNull())
    deduped = exact_greedy_dedup(passed, ["user_id", "event_type"], [-F.col("value")], "event_id") \
        .select("event_id", "dedup_code", "duplicate_of")
    out = judged.join(deduped, "event_id", "left")
    code = F.coalesce(F.col("failure_code"), F.col("dedup_code"))
    return out.select("event_id", "user_id", "event_type", "value",
                      F.when(code.isNull(), F.lit(codes.ACCEPTED)).otherwise(F.lit(codes.REJECTED)).alias("status"),
                      code.alias("failure_code"), "score", "duplicate_of")


@query("select_regression_events", """
WITH v AS (
  SELECT event_id, user_id, event_type, value,
         CASE WHEN value IS NULL THEN 'wrong_type' WHEN isnan(value) THEN 'nan_detected'
              WHEN isinf(value) THEN 'infinity_detected'
              WHEN value < 10.0 OR value > 400.0 THEN 'range_error' END AS vcode
  FROM events),
p AS (
  SELECT event_id,
         first_value(event_id) OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS first_id
  FROM v WHERE vcode IS NULL)
SELECT v.event_id,
       CASE WHEN vcode IS NULL AND p.first_id = v.event_id THEN 'accepted' ELSE 'rejected' END AS status,
       COALESCE(vcode, CASE WHEN p.first_id <> v.event_id THEN 'duplicate_sample' END) AS failure_code,
       CASE WHEN vcode IS NULL THEN value END AS score,
       CASE WHEN p.first_id <> v.event_id THEN p.first_id END AS duplicate_of
FROM v LEFT JOIN p ON v.event_id = p.event_id
""")
def select_regression_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression_selection(spark, sf_dir).select("event_id", "status", "failure_code", "score", "duplicate_of")


def classification_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels joined to documents, made into classification predictions."""
    lab = read_table(spark, sf_dir, "labels")
    doc = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    p_high = F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))
    return lab.join(doc, "doc_id").select(
        "doc_id",
        F.when(F.col("lang") == "es", F.lit(codes.REGRESSION)).otherwise(F.lit(codes.CLASSIFICATION)).alias("mode"),
        F.when(F.col("source") == "src0", F.lit(" ")).otherwise(F.col("source")).alias("pipeline_id"),
        F.when(F.col("toxic") == 1, F.lit("toxic")).when(F.col("quality") == 1, F.lit("high")).otherwise(F.lit("low")).alias("prediction"),
        F.array(F.struct(F.lit("high").alias("label"), p_high.alias("probability")),
                F.struct(F.lit("low").alias("label"), (F.lit(1.0) - p_high).alias("probability"))).alias("probabilities"),
    )


@query("select_classification", """
WITH d AS (
  SELECT l.doc_id,
         CASE WHEN d.lang = 'es' THEN 'regression' ELSE 'classification' END AS mode,
         CASE WHEN d.source = 'src0' THEN ' ' ELSE d.source END AS pipeline_id,
         CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 1 THEN 'high' ELSE 'low' END AS prediction,
         d.n_chars / (d.n_chars + 1000.0) AS p_high
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
c AS (
  SELECT *, CASE WHEN prediction = 'high' THEN p_high WHEN prediction = 'low' THEN 1.0 - p_high END AS conf
  FROM d),
v AS (
  SELECT doc_id, conf,
         CASE WHEN mode <> 'classification' THEN 'wrong_prediction_mode'
              WHEN trim(pipeline_id) = '' THEN 'missing_pipeline_identity'
              WHEN prediction NOT IN ('high', 'low') THEN 'invalid_class'
              WHEN isnan(p_high) OR p_high < 0 OR p_high > 1 OR 1.0 - p_high < 0 OR 1.0 - p_high > 1 THEN 'invalid_probability'
              WHEN abs(p_high + (1.0 - p_high) - 1.0) > 1e-6 THEN 'invalid_probability'
              WHEN conf < 0.6 THEN 'confidence_error' END AS failure_code
  FROM c)
SELECT doc_id, CASE WHEN failure_code IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
       failure_code, CASE WHEN failure_code IS NULL THEN conf END AS score
FROM v
""")
def select_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = classification_verdict(classification_input(spark, sf_dir), CLASSES)
    return judged.select("doc_id", _status().alias("status"), "failure_code", "score")


@query("run_counters", """
WITH s AS (
  SELECT e.event_type AS run_id, r.status, e.value
  FROM events e LEFT JOIN (SELECT event_id, status FROM (@select_regression_events@)) r ON e.event_id = r.event_id)
SELECT run_id,
       CAST(count(*) AS BIGINT) AS total_items,
       CAST(count(status) AS BIGINT) AS processed_items,
       CAST(count(*) FILTER (WHERE status = 'accepted') AS BIGINT) AS accepted_items,
       CAST(count(*) FILTER (WHERE status = 'rejected') AS BIGINT) AS rejected_items,
       CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) AS failed_items,
       CASE WHEN count(*) FILTER (WHERE value IS NULL) > 0 THEN 'failed' ELSE 'completed' END AS run_status
FROM s GROUP BY run_id
""")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + H6: counters recomputed from the verdicts; a run with any failed
    item (no prediction) ends failed."""
    from ..operators.lifecycle import run_counters as counters, run_outcome

    sel = regression_selection(spark, sf_dir).select(
        F.col("event_type").alias("run_id"),
        F.when(F.col("value").isNull(), F.lit("failed")).otherwise(F.col("status")).alias("task_status"))
    return run_outcome(counters(sel, "run_id", "task_status")).select(
        "run_id", "total_items", "processed_items", "accepted_items", "rejected_items", "failed_items", "run_status")


@query("rejection_stats", """
WITH r AS (
  SELECT 'ml_regression' AS branch, failure_code FROM (@select_regression_events@) WHERE status = 'rejected'
  UNION ALL
  SELECT 'ml_classification' AS branch, failure_code FROM (@select_classification@) WHERE status = 'rejected'),
g AS (SELECT branch, failure_code, count(*) AS n FROM r GROUP BY ROLLUP (branch, failure_code))
SELECT branch, failure_code, CAST(n AS BIGINT) AS n_rejected,
       round(n / (SELECT count(*) FROM r), 6) AS share
FROM g
""")
def rejection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.reports import rejection_stats as stats

    reg = select_regression_events(spark, sf_dir).select(F.lit("ml_regression").alias("branch"), "status", "failure_code")
    cls = select_classification(spark, sf_dir).select(F.lit("ml_classification").alias("branch"), "status", "failure_code")
    return stats(reg.unionByName(cls), ["branch", "failure_code"])


@query("exact_dedup_lineitem", """
WITH x AS (
  SELECT lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || '-'
           || lpad(CAST(l_partkey AS VARCHAR), 10, '0') || '-' || lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS sample_id,
         l_partkey, l_suppkey, l_extendedprice FROM lineitem),
f AS (
  SELECT *, first_value(sample_id) OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_extendedprice DESC, sample_id) AS first_id
  FROM x)
SELECT sample_id, CASE WHEN sample_id = first_id THEN 'accepted' ELSE 'rejected' END AS status,
       CASE WHEN sample_id = first_id THEN NULL ELSE first_id END AS duplicate_of
FROM f
""")
def exact_dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 on lineitem: (part, supplier) is the input identity, higher
    extended price first; one sample per identity is accepted."""
    li = spread(read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                             "l_extendedprice"))
    sid = F.concat_ws("-", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"),
                      F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
                      F.lpad(F.col("l_partkey").cast("string"), 10, "0"),
                      F.lpad(F.col("l_suppkey").cast("string"), 10, "0"))
    x = li.select(sid.alias("sample_id"), "l_partkey", "l_suppkey", "l_extendedprice")
    out = exact_greedy_dedup(x, ["l_partkey", "l_suppkey"], [-F.col("l_extendedprice")], "sample_id")
    return out.select("sample_id", _status("dedup_code").alias("status"), "duplicate_of")
