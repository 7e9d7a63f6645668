"""Export: the six-way scan, record shapes, checks and publication
(A7, A8, A9, A10, B16-B19, C8, E3).

Records are built as one JSON ``line`` column (keys sorted, nulls kept),
globally sorted by sample id and written as text into a new version
directory.  A numbered manifest naming the version is added last and none
is ever replaced: readers follow the highest one, so a failed export leaves
the previous version in force (Spark publishes directories, not single files).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import codes
from ..functions.jsonops import canonical_json
from ..functions.text import non_blank
from ..operators.validate import assert_empty


def export_scan(samples: DataFrame, tasks: DataFrame, generations: DataFrame, validations: DataFrame,
                runs: DataFrame, models: DataFrame, branch: str, dataset_id: str | None) -> DataFrame:
    """The 30 columns of samples joined to their task, generation,
    validation, run and model, of one dataset or of all.  runs and model_registry are small dimension tables; AQE
    broadcasts them at run time when they are."""
    c = F.col
    s = samples.filter(c("status").isin(codes.ACCEPTED, codes.REJECTED) & (F.lit(True) if dataset_id is None else c("dataset_id") == dataset_id))
    s = s.select("sample_id", "task_id", "generation_id", "validation_id", "run_id", "model_id", "dataset_id", "selector_version", "completion",
                 c("status").alias("sample_status"), c("score").alias("sample_score"), c("failure_code").alias("sample_failure_code"),
                 c("failure_reason").alias("sample_failure_reason"), c("metadata").alias("sample_metadata"), c("created_at").alias("sample_created_at"))
    t = tasks.select("task_id", c("input_payload").alias("task_input_payload"), c("expected_schema").alias("task_expected_schema"))
    g = generations.select("generation_id", "raw_output", "parsed_output", c("metadata").alias("generation_metadata"))
    v = validations.select("validation_id", "validator_version", "is_valid", c("score").alias("validation_score"),
                           c("failure_code").alias("validation_failure_code"), c("failure_reason").alias("validation_failure_reason"), "validation_details")
    r = runs.select("run_id", "config_id")
    m = models.filter(c("model_type") == branch).select("model_id", "model_name", "model_type", "base_model")
    return s.join(t, "task_id").join(g, "generation_id").join(v, "validation_id").join(r, "run_id").join(m, "model_id")


def _object(fields: dict[str, Column]) -> Column:
    """JSON text of an object from JSON texts, keys sorted, null members kept."""
    parts = []
    for i, k in enumerate(sorted(fields)):
        parts += [F.lit(("," if i else "{") + json.dumps(k) + ":"), F.coalesce(fields[k], F.lit("null"))]
    return F.concat(*parts, F.lit("}"))


def _scalar(value: Column) -> Column:
    """JSON text of a text, number or boolean (null: null)."""
    whole = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNotNull(), F.substring(whole, F.lit(6), F.length(whole) - 6))


def _member(doc: Column, key: str) -> Column:
    """JSON text of a member of an object given as text; null if absent or JSON null."""
    return F.to_json(F.try_variant_get(F.try_parse_json(doc), f"$.{key}", "variant"))


def _text_kind(value: Column) -> Column:
    """A JSON text; null for every other kind, JSON null included."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _instant(ts: Column) -> Column:
    """ISO 8601 in UTC; microseconds only where there are any."""
    micros = F.unix_micros(ts) % 1000000 != 0
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros, F.date_format(ts, ".SSSSSS")).otherwise(F.lit("")), F.lit("+00:00"))


def _common_members(branch: str) -> dict[str, Column]:
    c = F.col
    return {
        "sample_type": F.lit(json.dumps(branch)), "sample_id": _scalar(c("sample_id")), "dataset_id": _scalar(c("dataset_id")),
        "status": _scalar(c("sample_status")),
        "provenance": _object({"run_id": _scalar(c("run_id")), "generation_id": _scalar(c("generation_id")), "config_id": _scalar(c("config_id")),
                               "selector_version": _scalar(c("selector_version")), "created_at": _scalar(_instant(c("sample_created_at")))}),
        "disposition": _object({"score": _scalar(c("sample_score").cast("double")), "failure_code": _scalar(c("sample_failure_code")),
                                "failure_reason": _scalar(c("sample_failure_reason"))}),
    }


def _validation_members() -> dict[str, Column]:
    c = F.col
    return {"validation_id": _scalar(c("validation_id")), "validator_version": _scalar(c("validator_version")), "is_valid": _scalar(c("is_valid")),
            "failure_code": _scalar(c("validation_failure_code")), "failure_reason": _scalar(c("validation_failure_reason")),
            "evidence": first_object(c("validation_details"))}


#: The keys a component profile has, no more and no fewer.
PROFILE_KEYS = ("pipeline_id", "runtime_id", "modalities", "output_contract", "evaluators")


def llm_records(rows: DataFrame) -> DataFrame:
    """sample_id, sample_status, ``line`` (one JSON record, keys sorted at every level) and
    ``problem`` (why a row cannot be exported, else null) of an LLM export scan."""
    c = F.col
    profile = F.coalesce(_member(c("sample_metadata"), "component_profile"), _member(c("generation_metadata"), "component_profile"))
    problem = (F.when(c("model_type") != "llm", F.lit("not an llm row"))
               .when(first_object(profile).isNull(), F.lit("component profile is missing"))
               .when(~same_key_set(profile, F.lit(json.dumps(dict.fromkeys(PROFILE_KEYS)))), F.lit("component profile has other keys"))
               .when(first_object(c("validation_details")).isNull(), F.lit("validation evidence is missing")))
    line = _object(_common_members("llm") | {
        "task": _object({"task_id": _scalar(c("task_id")), "prompt": _member(c("task_input_payload"), "prompt"),
                         "messages": _member(c("task_input_payload"), "messages"),
                         "expected_schema": F.coalesce(first_object(c("task_expected_schema")), _member(c("task_input_payload"), "expected_schema"))}),
        "completion": _object({"raw": _scalar(first_present(c("completion"), c("raw_output"))),
                               "structured": F.coalesce(c("parsed_output"), _member(c("validation_details"), "output_payload"))}),
        "validation": _object(_validation_members() | {"score": _scalar(c("validation_score").cast("double"))}),
        "components": profile,
        "model": _object({k: _scalar(c(k)) for k in ("model_id", "model_name", "model_type", "base_model")}),
    })
    return rows.select("sample_id", "sample_status", canonical_json(line).alias("line"), problem.alias("problem"))


def ml_records(rows: DataFrame) -> DataFrame:
    """A10: as ``llm_records`` for an ML export scan.  An identity is taken from the first document
    that has its key, whatever stands there, and must then be a non-blank text."""
    c = F.col
    pick = lambda key, *docs: _text_kind(F.coalesce(*[F.try_variant_get(F.try_parse_json(d), f"$.{key}", "variant") for d in docs]))
    pipeline = pick("pipeline_id", c("parsed_output"), c("generation_metadata"), c("sample_metadata"))
    artifact = pick("artifact_identity", c("generation_metadata"), c("sample_metadata"))
    problem = (F.when(c("model_type") != "ml", F.lit("not an ml row"))
               .when(~F.coalesce(non_blank(pipeline), F.lit(False)), F.lit("pipeline identity is missing"))
               .when(~F.coalesce(non_blank(artifact), F.lit(False)), F.lit("artifact identity is missing"))
               .when(~relative_path_ok(artifact), F.lit("artifact identity is an absolute path"))
               .when(first_object(c("validation_details")).isNull(), F.lit("validation evidence is missing")))
    line = _object(_common_members("ml") | {
        "task": _object({"task_id": _scalar(c("task_id")), "features": c("task_input_payload")}),
        "decision": _object({"prediction": _member(c("parsed_output"), "prediction"), "probabilities": _member(c("parsed_output"), "probabilities"),
                             "score": _scalar(c("validation_score").cast("double"))}),
        "validation": _object(_validation_members()),
        "pipeline": _object({"pipeline_id": _scalar(pipeline), "artifact_identity": _scalar(artifact)}),
        "model": _object({k: _scalar(c(k)) for k in ("model_id", "model_name", "model_type")}),
    })
    return rows.select("sample_id", "sample_status", canonical_json(line).alias("line"), problem.alias("problem"))


def consistency_violations(rows: DataFrame, branch: str, dataset_id: str | None = None) -> DataFrame:
    """Branch and dataset match; accepted <=> is_valid (a missing one is
    neither); accepted has no failure code and no reason; rejected has a code.  Adds ``violation`` naming the first rule broken."""
    ds = (F.col("dataset_id") != dataset_id) if dataset_id is not None else F.lit(False)
    if "sample_status" in rows.columns:  # an export scan
        names = {"sample_status": "status", "sample_failure_code": "failure_code", "sample_failure_reason": "failure_reason"}
        return consistency_violations(rows.withColumnsRenamed(names), branch, dataset_id)
    acc = F.col("status") == codes.ACCEPTED
    reason = F.col("failure_reason").isNotNull() if "failure_reason" in rows.columns else F.lit(False)
    why = (F.when(~F.col("model_type").eqNullSafe(F.lit(branch)), F.lit("branch_mismatch"))
           .when(ds, F.lit("dataset_mismatch"))
           .when(~acc.eqNullSafe(F.col("is_valid")), F.lit("validity_mismatch"))
           .when(acc & (F.col("failure_code").isNotNull() | reason), F.lit("accepted_with_failure"))
           .when(~acc & F.col("failure_code").isNull(), F.lit("rejected_without_code")))
    return rows.withColumn("violation", why).filter(F.col("violation").isNotNull())


def json_line(cols: dict[str, Column]) -> Column:
    """One compact JSON object, keys sorted, nulls kept."""
    fields = [cols[k].alias(k) for k in sorted(cols)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def publish(spark: SparkSession, parts: dict[str, DataFrame], root: str, sort_col: str = "sample_id",
            violations: DataFrame | None = None) -> str:
    """Write every part (``branch/status`` -> frame with ``line``) into
    a fresh version directory, then add the next manifest.  Checks run
    before anything is written; any failure leaves the previous manifest in
    force.  One export at a time is assumed."""
    if violations is not None:
        assert_empty(violations, "export consistency")
    version = uuid.uuid4().hex[:12]
    base = f"{root.rstrip('/')}/v={version}"
    written = {}
    for name, df in parts.items():
        path = f"{base}/{name}"
        # one global sort by sample id (code-point order = UTF-8 byte order)
        df.orderBy(sort_col).select("line").write.mode("errorifexists").text(path)
        written[name] = path
    number = 1 + max((m["number"] for m in _manifests(spark, root)), default=0)
    manifest = spark.createDataFrame([(json.dumps({"number": number, "version": version, "parts": written}, sort_keys=True),)], "value string")
    manifest.coalesce(1).write.mode("append").text(f"{root.rstrip('/')}/manifests")
    return version


def _manifests(spark: SparkSession, root: str) -> list[dict]:
    """One small line per export so far."""
    try:
        return [json.loads(r[0]) for r in spark.read.text(f"{root.rstrip('/')}/manifests").collect()]
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def read_current(spark: SparkSession, root: str) -> dict:
    """The manifest in force: the highest number."""
    return max(_manifests(spark, root), key=lambda m: m["number"])


def first_present(*texts: Column) -> Column:
    """B17 for text: Python ``or`` skips null and the empty string; ``{}`` is a text like any other."""
    return F.coalesce(*[F.when(t != "", t) for t in texts])


def first_object(*objects: Column) -> Column:
    """B17 for JSON objects given as text: Python ``or`` skips null and an object without members."""
    empty = r"\s*(\{\s*\}|null)?\s*"
    return F.coalesce(*[F.when(~o.rlike(f"^{empty}$"), o) for o in objects])


def same_key_set(a_json: Column, b_json: Column) -> Column:
    """Two JSON objects have the same set of top-level keys."""
    return F.array_sort(F.json_object_keys(a_json)) == F.array_sort(F.json_object_keys(b_json))


def relative_path_ok(path: Column) -> Column:
    """Artifact paths must be relative (no leading slash)."""
    return path.isNotNull() & ~path.startswith("/")
