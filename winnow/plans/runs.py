"""Whole runs of both branches on a store (C5, C6, D5, F2, F5, H1-H7, A5, A8), stopped and resumed."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.features import canonical_features
from ..operators.evaluate import LLMSettings, evaluate_llm, evaluate_ml
from ..operators.run import Branch, _append, publish_dataset, run_branch, stored, task_statuses
from ..operators.score import score
from ..operators.validate import RegressionSettings
from ..session import read_table, shared_dir
from ..sources.export import llm_records, ml_records, read_current
from .records import _PROFILE
from .registry import query

#: The vectors of the llm branch lie on a circle, so many to the round: neighbours are further apart than the threshold.
ROUND = 50
LLM = LLMSettings(max_characters=64, max_json_depth=4, max_cosine_distance=0.005, embedding_dimension=2, embedding_model="circle")
ML = RegressionSettings(minimum=0.0, maximum=2000.0)


def circle(text: Column) -> Column:
    """A vector for a canonical text: the angle is its number's share of a round."""
    turn = 2 * np.pi * (F.get_json_object(text, "$.n").cast("long") % ROUND) / ROUND
    return F.array(F.cos(turn), F.sin(turn))


def llm_branch(spark: SparkSession, source: DataFrame) -> Branch:
    """``source``: (k long).  Every thirteenth call fails; outputs are empty, no JSON, of a wrong type or right."""
    k = F.col("source_id").cast("long")

    def execute(tasks: DataFrame) -> DataFrame:
        answer = (F.when(k % 7 == 0, F.lit("")).when(k % 7 == 1, F.lit("no JSON")).when(k % 7 == 2, F.lit('{"n":"x"}'))
                  .otherwise(F.format_string('{"n": %d}', k)))
        lost = k % 13 == 0
        return tasks.select("task_id", answer.alias("raw_output"), F.when(k % 7 > 2, answer).alias("parsed_output"),
                            F.lit('{"component_profile":' + _PROFILE + "}").alias("metadata"), F.when(lost, F.lit("TimeoutError")).alias("error_type"),
                            F.when(lost, F.lit("no answer")).alias("error_message"))

    def evaluate(rows: DataFrame, accepted: DataFrame) -> DataFrame:
        prior = accepted.select("dataset_id", "generation_id", "embedding")
        out = evaluate_llm(rows, LLM, order=[("position", True)], embed=circle, prior_accepted=prior)
        return out.select("generation_id", "status", "failure_code", F.lit(None).cast("string").alias("failure_reason"),
                          F.lit(None).cast("double").alias("score"), F.to_json(F.struct("evidence")).alias("details"), "embedding")

    items = source.select(F.col("k").cast("string").alias("source_id"), F.col("k").alias("position"),
                          F.format_string('{"prompt":"Number %d"}', "k").alias("input_payload"),
                          F.lit('{"type":"object","required":["n"],"properties":{"n":{"type":"integer"}}}').alias("expected_schema"))
    return Branch("llm", "MO_llm", "numbers", "config_v001", items, execute, evaluate, embedding_model=LLM.embedding_model)


class PriceModel:
    """Price times size; a size of 13 is beyond it."""

    def predict(self, x):
        return np.where(x[:, 1] == 13, np.nan, x[:, 0] * x[:, 1] / 10)


def ml_branch(spark: SparkSession, source: DataFrame) -> Branch:
    """``source``: (k long, price double, size long).  The model has no finite answer for one size."""
    def execute(tasks: DataFrame) -> DataFrame:
        typed = tasks.select("task_id", F.get_json_object("input_payload", "$.price").cast("double").alias("price"),
                             F.get_json_object("input_payload", "$.size").cast("double").alias("size"))
        out = score(typed, ["task_id"], ["price", "size"], PriceModel, codes.REGRESSION, "price_model")
        parsed = F.to_json(F.struct("pipeline_id", "mode", "prediction"))
        return out.select("task_id", parsed.alias("raw_output"), parsed.alias("parsed_output"), F.lit('{"artifact_identity":"models/price.bin"}').alias("metadata"),
                          "error_type", "error_message")

    def keys(payload: Column) -> list[Column]:
        return [F.get_json_object(payload, "$.price").alias("price"), F.get_json_object(payload, "$.size").alias("size")]

    def evaluate(rows: DataFrame, accepted: DataFrame) -> DataFrame:
        member = lambda name: F.get_json_object("parsed_output", f"$.{name}")
        x = rows.select("generation_id", "dataset_id", "position", *keys(F.col("input_payload")), member("mode").alias("mode"), member("pipeline_id").alias("pipeline_id"),
                        member("prediction").cast("double").alias("prediction"), F.lit(None).cast("array<struct<label:string,probability:double>>").alias("probabilities"))
        prior = accepted.select("dataset_id", "generation_id", *keys(F.col("input_payload")))
        feature = lambda df: df.withColumn("feature", canonical_features(["price", "size"]))
        out = evaluate_ml(feature(x), ML, ["feature"], "generation_id", order=[F.col("position")], accepted=feature(prior))
        return out.select("generation_id", "status", "failure_code", F.lit(None).cast("string").alias("failure_reason"), "score",
                          F.to_json(F.struct("evidence")).alias("details"))

    items = source.select(F.col("k").cast("string").alias("source_id"), F.col("k").alias("position"),
                          F.to_json(F.struct("price", "size")).alias("input_payload"), F.lit(None).cast("string").alias("expected_schema"))
    return Branch("ml", "MO_ml", "prices", "config_v001", items, execute, evaluate)


def register_models(spark: SparkSession, root: str) -> None:
    models = spark.createDataFrame([("MO_llm", "answers", "llm", "base"), ("MO_ml", "prices", "ml", None)], "model_id string, model_name string, model_type string, base_model string")
    _append(spark, models, root, "model_registry")


def outcome(spark: SparkSession, root: str, out: str, run_id: str) -> DataFrame:
    """(source_id, status, failure_code, error_type, published): each task, its verdict, and the part in which its line stands."""
    s = stored(spark, root, "samples").select("task_id", "sample_id", "failure_code")
    parts = read_current(spark, out)["parts"]
    lines = [spark.read.text(p).select(F.get_json_object("value", "$.sample_id").alias("_sample"), F.lit(name).alias("published")) for name, p in parts.items()]
    both = lines[0].unionByName(lines[1])
    t = task_statuses(spark, root, run_id).select("task_id", "source_id", "status", "error_type")
    return t.join(s, "task_id", "left").join(both, F.col("sample_id") == F.col("_sample"), "left").select(
        F.col("source_id").cast("long").alias("source_id"), "status", "failure_code", "error_type", "published")


@query("run_llm_branch", f"""
WITH t AS (
  SELECT c_custkey AS k,
         CASE WHEN c_custkey % 13 = 0 THEN 'TimeoutError' END AS error_type,
         CASE c_custkey % 7 WHEN 0 THEN 'empty_output' WHEN 1 THEN 'invalid_json' WHEN 2 THEN 'schema_error' END AS code
  FROM customer),
d AS (SELECT *, row_number() OVER (PARTITION BY k % {ROUND} ORDER BY k) AS r FROM t WHERE code IS NULL AND error_type IS NULL),
v AS (SELECT t.*, coalesce(t.code, CASE WHEN d.r > 1 THEN 'duplicate_sample' END) AS failure_code FROM t LEFT JOIN d ON t.k = d.k)
SELECT k AS source_id, CASE WHEN error_type IS NOT NULL THEN 'failed' WHEN failure_code IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
       CASE WHEN error_type IS NULL THEN failure_code END AS failure_code, error_type,
       CASE WHEN error_type IS NOT NULL THEN NULL WHEN failure_code IS NULL THEN 'golden' ELSE 'rejected' END AS published
FROM v
""")
def run_llm_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One llm run over customers, stopped after its execution and resumed, then published and read back."""
    base = shared_dir(spark, f"run-{uuid.uuid4().hex}")
    root, out = f"{base}/store", f"{base}/published"
    register_models(spark, root)
    branch = llm_branch(spark, read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")))
    run_branch(spark, root, branch, stop_after="execute")
    run_id = run_branch(spark, root, branch)
    publish_dataset(spark, root, out, branch, llm_records)
    return outcome(spark, root, out, run_id)


@query("run_ml_branch", """
WITH t AS (
  SELECT p_partkey AS k, p_size, p_retailprice, CASE WHEN p_size = 13 THEN 'ValueError' END AS error_type,
         CASE WHEN p_retailprice::DOUBLE * p_size / 10 > 2000 THEN 'range_error' END AS code
  FROM part),
d AS (SELECT *, row_number() OVER (PARTITION BY p_size, p_retailprice ORDER BY k) AS r FROM t WHERE code IS NULL AND error_type IS NULL),
v AS (SELECT t.*, coalesce(t.code, CASE WHEN d.r > 1 THEN 'duplicate_sample' END) AS failure_code FROM t LEFT JOIN d ON t.k = d.k)
SELECT k AS source_id, CASE WHEN error_type IS NOT NULL THEN 'failed' WHEN failure_code IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
       CASE WHEN error_type IS NULL THEN failure_code END AS failure_code, error_type,
       CASE WHEN error_type IS NOT NULL THEN NULL WHEN failure_code IS NULL THEN 'golden' ELSE 'rejected' END AS published
FROM v
""")
def run_ml_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ml run over parts, stopped after its evaluation and resumed, then published and read back."""
    base = shared_dir(spark, f"run-{uuid.uuid4().hex}")
    root, out = f"{base}/store", f"{base}/published"
    register_models(spark, root)
    parts = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_retailprice").cast("double").alias("price"), F.col("p_size").cast("long").alias("size"))
    branch = ml_branch(spark, parts)
    run_branch(spark, root, branch, stop_after="evaluate")
    run_id = run_branch(spark, root, branch)
    publish_dataset(spark, root, out, branch, ml_records)
    return outcome(spark, root, out, run_id)
