"""Staged, short-circuiting evaluation with evidence.

Each stage runs only on the survivors of the previous one (explicit
``filter`` before the expensive step, as Catalyst will not reorder around
a pandas UDF), adds one evidence record, and the rows are unioned back.
Evidence: ``array<struct<check_id, passed, code, details>>`` with details
as compact JSON text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.jsonops import canonical_json, structured_json_gate
from .dedup import exact_greedy_dedup
from .jsonschema import check_against_schemas
from .similarity import DEFAULT_TILE_ROWS, semantic_dedup_with_evidence
from .validate import ClassificationSettings, RegressionSettings, classification_verdict, regression_verdict

EVIDENCE_TYPE = "array<struct<check_id:string,passed:boolean,code:string,details:string>>"


def evidence(check_id: str, passed: Column, code: Column, details: Column) -> Column:
    return F.array(F.struct(F.lit(check_id).alias("check_id"), passed.alias("passed"),
                            code.cast("string").alias("code"), details.alias("details")))


@dataclass(frozen=True)
class LLMSettings:
    max_characters: int = 4096
    max_json_depth: int = 16
    max_cosine_distance: float = 0.05
    embedding_dimension: int = 768
    embedding_model: str = "embedder"
    tile_rows: int = DEFAULT_TILE_ROWS


def evaluate_llm(df: DataFrame, s: LLMSettings, id_col: str = "generation_id", text_col: str = "raw_output",
                 schema_col: str = "expected_schema", dataset_col: str = "dataset_id",
                 order: Sequence[tuple[str, bool]] | None = None,
                 embed: Callable[[Column], Column] | None = None, embedding_col: str | None = None,
                 prior_accepted: DataFrame | None = None) -> DataFrame:
    """Structured JSON -> JSON Schema -> semantic dedup.

    ``embed`` maps the canonical text column to an embedding column (e.g. a
    pandas UDF); it runs only on rows that passed the first two stages, and its result is
    returned as ``embedding`` (null for the others), to be stored.
    ``prior_accepted``: (dataset, id, embedding) of samples already accepted."""
    gate = df.withColumn("_gate", structured_json_gate(F.col(text_col), s.max_characters, s.max_json_depth))
    g_fail = gate.filter(F.col("_gate").isNotNull()).select(
        id_col, F.lit(codes.REJECTED).alias("status"), F.col("_gate").alias("failure_code"),
        evidence(codes.CHECK_STRUCTURED_JSON, F.lit(False), F.col("_gate"),
                 F.to_json(F.struct(F.lit("structured JSON contract failed").alias("message")))).alias("evidence"),
        F.lit(None).cast("string").alias("canonical_text"), F.lit(None).cast("array<double>").alias("embedding"))
    ok = gate.filter(F.col("_gate").isNull()).withColumn("canonical_text", canonical_json(F.col(text_col)))
    ev1 = evidence(codes.CHECK_STRUCTURED_JSON, F.lit(True), F.lit(None),
                   F.to_json(F.struct(F.length("canonical_text").alias("canonical_characters"))))
    ok = ok.withColumn("evidence", ev1).withColumn("_doc", F.try_parse_json(F.col(text_col)))
    sc = check_against_schemas(ok, "_doc", schema_col)
    details = F.to_json(F.struct(F.lit("draft_2020_12").alias("validator"), F.col("schema_error_count").alias("error_count"),
                                 F.col("schema_first_path").alias("path"), F.col("schema_first_message").alias("message")))
    sc = sc.withColumn("evidence", F.concat("evidence", evidence(codes.CHECK_JSON_SCHEMA, F.col("schema_code").isNull(),
                                                                  F.col("schema_code"), details)))
    s_fail = sc.filter(F.col("schema_code").isNotNull()).select(
        id_col, F.lit(codes.REJECTED).alias("status"), F.col("schema_code").alias("failure_code"), "evidence", "canonical_text",
        F.lit(None).cast("array<double>").alias("embedding"))
    passed = sc.filter(F.col("schema_code").isNull())
    if embed is not None:
        # once per surviving row: the dedup below reads the vectors several times
        passed = passed.withColumn("_emb", embed(F.col("canonical_text"))).checkpoint(eager=True)
    else:
        passed = passed.withColumn("_emb", F.col(embedding_col))
    passed = passed.withColumn("_model", F.lit(s.embedding_model))
    verdict, _ = semantic_dedup_with_evidence(
        passed.select(id_col, dataset_col, "_model", "_emb", *[c for c, _ in (order or []) if c not in (id_col, dataset_col)]),
        [dataset_col, "_model"], id_col, "_emb", s.max_cosine_distance, s.embedding_dimension, order,
        prior_accepted.withColumn("_model", F.lit(s.embedding_model)).withColumnRenamed("embedding", "_emb")
        if prior_accepted is not None else None, s.tile_rows)
    d3 = F.to_json(F.struct(F.lit(s.embedding_model).alias("embedding_model_id"), F.col("nearest_id").alias("nearest_sample_id"),
                            F.col("distance").alias("cosine_distance"), F.lit(s.max_cosine_distance).alias("max_cosine_distance")))
    v = verdict.withColumn("_ev3", evidence(codes.CHECK_SEMANTIC_DEDUP, F.col("failure_code").isNull(), F.col("failure_code"), d3))
    sem = passed.select(id_col, "evidence", "canonical_text", F.col("_emb").cast("array<double>").alias("embedding")).join(v, id_col).select(
        id_col, "status", "failure_code", F.concat("evidence", "_ev3").alias("evidence"), "canonical_text", "embedding")
    return g_fail.unionByName(s_fail).unionByName(sem)


def evaluate_ml(df: DataFrame, settings: ClassificationSettings | RegressionSettings, key_cols: Sequence[str],
                id_col: str = "sample_id", dataset_col: str = "dataset_id", order: Sequence[Column] | None = None,
                accepted: DataFrame | None = None) -> DataFrame:
    """Prediction rule, then exact dedup on the typed features within
    the dataset; a duplicate keeps the validation score."""
    judged = (classification_verdict(df, settings) if isinstance(settings, ClassificationSettings)
              else regression_verdict(df, settings))
    ev1 = evidence(codes.CHECK_ML_VALIDATION, F.col("failure_code").isNull(), F.col("failure_code"),
                   F.to_json(F.struct(F.col("score").alias("score"))))
    # read three times below; without it each of them makes the rows and their verdicts again
    judged = judged.withColumn("evidence", ev1).checkpoint(eager=True)
    fail = judged.filter(F.col("failure_code").isNotNull()).select(
        id_col, F.lit(codes.REJECTED).alias("status"), "failure_code", "score", "evidence",
        F.lit(None).cast(df.schema[id_col].dataType).alias("duplicate_of"))
    ok = judged.filter(F.col("failure_code").isNull())
    dd = exact_greedy_dedup(ok, list(key_cols), list(order or []), id_col, [dataset_col], accepted, id_col)
    ev2 = evidence(codes.CHECK_EXACT_DEDUP, F.col("dedup_code").isNull(), F.col("dedup_code"),
                   F.to_json(F.struct(F.col("duplicate_of").cast("string").alias("duplicate_sample_id"))))
    done = dd.select(id_col, F.when(F.col("dedup_code").isNull(), F.lit(codes.ACCEPTED)).otherwise(F.lit(codes.REJECTED)).alias("status"),
                     F.col("dedup_code").alias("failure_code"), "score", F.concat("evidence", ev2).alias("evidence"), "duplicate_of")
    return fail.unionByName(done)
