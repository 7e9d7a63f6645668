"""Export records of both branches from a store of seven tables.

The store is built from ``labels`` and ``documents``: a labelled document is a task with one
generation, validation and sample; sources are runs and models, even ones of the llm branch,
odd ones of the ml branch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import assert_empty
from ..session import read_table
from ..sources.export import consistency_violations, export_scan, llm_records, ml_records
from .registry import query

_PROFILE = '{"pipeline_id":"single_turn","runtime_id":"local","modalities":["text"],"output_contract":"structured_json","evaluators":["json_schema","semantic_dedup"]}'


def store(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    doc = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    d = lab.join(doc, "doc_id")
    i, n, src, good = F.col("doc_id"), F.col("n_chars"), F.col("source"), F.col("quality") == 1
    llm = F.substring(src, 4, 9).cast("int") % 2 == 0
    share = F.round(n / (n + 1000.0), 4)
    fmt = F.format_string
    code, reason = F.when(~good, F.lit("schema_error")), F.when(~good, F.lit("not as expected"))
    tasks = d.select(
        fmt("TA%d", i).alias("task_id"),
        F.when(llm, fmt('{"prompt":"Rate document %d","expected_schema":{"type":"object"}}', i)).otherwise(fmt('{"n_chars":%d,"even":%s}', n, (i % 2 == 0).cast("string"))).alias("input_payload"),
        F.when(llm & (i % 2 == 1), F.lit('{"type":"object","required":["n"]}')).when(llm & (i % 4 == 0), F.lit("{}")).alias("expected_schema"))
    generations = d.select(
        fmt("GE%d", i).alias("generation_id"), fmt('{"n": %d}', n).alias("raw_output"),
        F.when(llm & (i % 3 != 0), fmt('{"n":%d}', n)).when(~llm, F.when((i % 3 == 0) & (i % 7 == 0), fmt('{"pipeline_id":null,"prediction":"high"}')).when((i % 3 == 0) & (i % 7 == 1), fmt('{"pipeline_id":7,"prediction":"high"}')).when(i % 3 == 0, fmt('{"prediction":"high"}')).otherwise(fmt('{"pipeline_id":"generic","prediction":"low","probabilities":{"high":0.25,"low":0.75}}'))).alias("parsed_output"),
        F.when(llm, F.lit('{"component_profile":' + _PROFILE + "}")).when(i % 11 == 0, F.lit('{"artifact_identity":null,"pipeline_id":"from_generation"}')).when(i % 13 == 0, F.lit("{}")).otherwise(F.lit('{"artifact_identity":"models/a.bin","pipeline_id":"from_generation"}')).alias("metadata"))
    validations = d.select(
        fmt("VA%d", i).alias("validation_id"), F.lit("v001").alias("validator_version"), good.alias("is_valid"), share.alias("score"),
        code.alias("failure_code"), reason.alias("failure_reason"),
        fmt('{"evidence":[{"check_id":"fixture","passed":%s}],"output_payload":{"n":%d}}', good.cast("string"), n).alias("validation_details"))
    samples = d.select(
        fmt("SA%d", i).alias("sample_id"), fmt("TA%d", i).alias("task_id"), fmt("GE%d", i).alias("generation_id"), fmt("VA%d", i).alias("validation_id"),
        src.alias("run_id"), src.alias("model_id"), F.col("lang").alias("dataset_id"), F.lit("v001").alias("selector_version"),
        F.when(i % 5 == 0, F.lit("")).when(i % 5 == 1, F.lit("{}")).alias("completion"),
        F.when(good, F.lit("accepted")).otherwise(F.lit("rejected")).alias("status"), F.when(good, share).alias("score"),
        code.alias("failure_code"), reason.alias("failure_reason"),
        F.when(llm, F.lit("{}")).otherwise(F.lit('{"artifact_identity":"models/s.bin","pipeline_id":"from_sample"}')).alias("metadata"),
        F.timestamp_seconds(F.lit(1700000000) + i).alias("created_at"))
    sources = doc.select("source", llm.alias("llm")).distinct()
    runs = sources.select(F.col("source").alias("run_id"), F.lit("config_v001").alias("config_id"))
    models = sources.select(F.col("source").alias("model_id"), F.concat(F.lit("model of "), "source").alias("model_name"),
                            F.when(F.col("llm"), F.lit("llm")).otherwise(F.lit("ml")).alias("model_type"), F.when(F.col("llm"), F.lit("base")).alias("base_model"))
    return {"samples": samples, "tasks": tasks, "generations": generations, "validations": validations, "runs": runs, "models": models}


_SQL = """
WITH d AS (
  SELECT l.doc_id AS i, l.quality = 1 AS good, d.lang, d.source, d.n_chars AS n, round(d.n_chars / (d.n_chars + 1000.0::DOUBLE), 4) AS share,
         CAST(substring(d.source, 4) AS INTEGER) % 2 = 0 AS llm
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
p AS (
  SELECT *, CASE WHEN good THEN 'accepted' ELSE 'rejected' END AS status, CASE WHEN NOT good THEN 'schema_error' END AS code,
         CASE WHEN NOT good THEN 'not as expected' END AS reason,
         json_object('config_id', 'config_v001', 'created_at', strftime(make_timestamp((1700000000 + i) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00',
                     'generation_id', 'GE' || i, 'run_id', source, 'selector_version', 'v001') AS provenance
  FROM d),
q AS (
  SELECT *, json_object('failure_code', code, 'failure_reason', reason, 'score', CASE WHEN good THEN share END) AS disposition,
         json_object('evidence', json_array(json_object('check_id', 'fixture', 'passed', good)), 'output_payload', json_object('n', n)) AS evidence
  FROM p)
"""


@query("export_llm_records", _SQL + """
SELECT 'SA' || i AS sample_id, status AS sample_status,
  json_object(
    'completion', json_object('raw', CASE WHEN i % 5 = 1 THEN '{}' ELSE '{"n": ' || n || '}' END, 'structured', json_object('n', n)),
    'components', json('{"evaluators":["json_schema","semantic_dedup"],"modalities":["text"],"output_contract":"structured_json","pipeline_id":"single_turn","runtime_id":"local"}'),
    'dataset_id', lang, 'disposition', disposition,
    'model', json_object('base_model', 'base', 'model_id', source, 'model_name', 'model of ' || source, 'model_type', 'llm'),
    'provenance', provenance, 'sample_id', 'SA' || i, 'sample_type', 'llm', 'status', status,
    'task', json_object('expected_schema', CASE WHEN i % 2 = 1 THEN json('{"required":["n"],"type":"object"}') ELSE json('{"type":"object"}') END,
                        'messages', NULL, 'prompt', 'Rate document ' || i, 'task_id', 'TA' || i),
    'validation', json_object('evidence', evidence, 'failure_code', code, 'failure_reason', reason, 'is_valid', good, 'score', share,
                              'validation_id', 'VA' || i, 'validator_version', 'v001'))::VARCHAR AS line,
  CAST(NULL AS VARCHAR) AS problem
FROM q WHERE llm
""")
def export_llm_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 + A9 + C8: the scan is checked before a record is made."""
    rows = export_scan(**store(spark, sf_dir), branch="llm", dataset_id=None)
    assert_empty(consistency_violations(rows, "llm"), "export consistency")
    return llm_records(rows)


@query("export_ml_records", _SQL + """
, m AS (
  SELECT *, CASE WHEN i % 3 <> 0 THEN 'generic' WHEN i % 7 IN (0, 1) THEN NULL WHEN i % 13 = 0 AND i % 11 <> 0 THEN 'from_sample' ELSE 'from_generation' END AS pid,
         CASE WHEN i % 11 = 0 THEN NULL WHEN i % 13 = 0 THEN 'models/s.bin' ELSE 'models/a.bin' END AS artifact
  FROM q WHERE NOT llm)
SELECT 'SA' || i AS sample_id, status AS sample_status,
  json_object(
    'dataset_id', lang,
    'decision', json_object('prediction', CASE WHEN i % 3 = 0 THEN 'high' ELSE 'low' END,
                            'probabilities', CASE WHEN i % 3 <> 0 THEN json('{"high":0.25,"low":0.75}') END, 'score', share),
    'disposition', disposition, 'model', json_object('model_id', source, 'model_name', 'model of ' || source, 'model_type', 'ml'),
    'pipeline', json_object('artifact_identity', artifact, 'pipeline_id', pid),
    'provenance', provenance, 'sample_id', 'SA' || i, 'sample_type', 'ml', 'status', status,
    'task', json_object('features', json_object('even', i % 2 = 0, 'n_chars', n), 'task_id', 'TA' || i),
    'validation', json_object('evidence', evidence, 'failure_code', code, 'failure_reason', reason, 'is_valid', good,
                              'validation_id', 'VA' || i, 'validator_version', 'v001'))::VARCHAR AS line,
  CASE WHEN pid IS NULL THEN 'pipeline identity is missing' WHEN artifact IS NULL THEN 'artifact identity is missing' END AS problem
FROM m
""")
def export_ml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 + A10 + C8 of the ml branch."""
    rows = export_scan(**store(spark, sf_dir), branch="ml", dataset_id=None)
    assert_empty(consistency_violations(rows, "ml"), "export consistency")
    return ml_records(rows)
