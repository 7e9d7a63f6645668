"""One run of a branch on the store: import, execute, evaluate, finalize, close, publish
(A3, A5, A8, C5, C6, C8, D5, E1, E2, F1, F2, H1-H7).

What is due is derived from the store, never from the process that stopped: a task without a
generation is executed, one whose generation has no validation is evaluated, one whose
validation has no sample is finalized.  Each stage takes all its due tasks at once, in
queue order, and appends one committed part; a stop before the part's commit line leaves nothing
of the stage, so the next run does it again.  Task statuses follow from what is stored
(failure, sample, generation), and a run's status is a log that only grows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.text import assign_ids, parse_id
from ..sources.export import consistency_violations, export_scan, publish
from ..sources.store import append_embeddings_once, append_once, first_per_key, import_tasks_once, read_store
from .lifecycle import (counter_violations, fail_tasks, finalize, illegal_transitions, latest_resumable_run, preflight_model, resume_items,
                        resume_match, run_counters, run_outcome)
from .validate import assert_empty

STAGES = ("import", "execute", "evaluate", "finalize")
#: Columns of the stored tables, in the order in which they are written.
SCHEMAS = {
    "model_registry": "model_id string, model_name string, model_type string, base_model string",
    "runs": "run_id string, seq int, model_id string, dataset_id string, config_id string, total_items long, status string, error_message string",
    "tasks": "task_id string, run_id string, source_id string, position long, input_payload string, expected_schema string",
    "generations": "generation_id string, task_id string, raw_output string, parsed_output string, metadata string",
    "validation_results": "validation_id string, generation_id string, validator_version string, is_valid boolean, score double, failure_code string, "
                          "failure_reason string, validation_details string",
    "samples": "sample_id string, task_id string, generation_id string, validation_id string, run_id string, model_id string, dataset_id string, "
               "selector_version string, completion string, status string, score double, failure_code string, failure_reason string, metadata string, created_at timestamp",
    "embeddings": "embedding_id string, source_type string, source_id string, embedding_model_id string, embedding array<double>",
    "failures": "task_id string, failure_seq int, error_type string, error_message string, error_traceback string",
}


@dataclass(frozen=True)
class Branch:
    """What a branch brings to a run.

    ``source``: (source_id, position, input_payload, expected_schema), one row per item.
    ``execute``: task rows -> task_id, raw_output, parsed_output, metadata, error_type, error_message
    (an error makes the task failed and its generation is not stored).
    ``evaluate``: (generation rows with their task's columns, accepted samples of the dataset with their stored
    outputs and embeddings) -> generation_id, status, failure_code, failure_reason, score, details, and
    ``embedding`` (null: none) if ``embedding_model`` is named; vectors are stored once and never made again."""

    branch_id: str
    model_id: str
    dataset_id: str
    config_id: str
    source: DataFrame
    execute: Callable[[DataFrame], DataFrame]
    evaluate: Callable[[DataFrame, DataFrame], DataFrame]
    selector_version: str = "v001"
    validator_version: str = "v001"
    embedding_model: str | None = None


def stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the store, empty if nothing was written yet."""
    df = read_store(spark, root, table)
    return spark.createDataFrame([], SCHEMAS[table]) if df is None else df


def _shaped(df: DataFrame, table: str) -> DataFrame:
    """The table's columns, missing ones null."""
    fields = df.sparkSession.createDataFrame([], SCHEMAS[table]).schema.fields
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def _append(spark: SparkSession, df: DataFrame, root: str, table: str, key: list[str] | None = None) -> DataFrame:
    return append_once(spark, _shaped(df, table), root, table, key)


def _next(table: DataFrame, id_col: str) -> int:
    top = table.agg(F.max(parse_id(F.col(id_col))["counter"])).first()[0]
    return 0 if top is None else top + 1


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """Each run with its last status."""
    log = stored(spark, root, "runs")
    return first_per_key(log, ["run_id"], [-F.col("seq")])


def _transition(spark: SparkSession, root: str, run_id: str, status: str, error: str | None = None) -> None:
    """H1 for the run: the step must be legal; a step already taken is not taken again."""
    now = run_log(spark, root).filter(F.col("run_id") == run_id).first()
    if now["status"] == status:
        return
    if (now["status"], status) not in codes.RUN_TRANSITIONS:
        raise ValueError(f"illegal run transition: {now['status']} -> {status}")
    row = {**now.asDict(), "seq": now["seq"] + 1, "status": status, "error_message": error}
    _append(spark, spark.createDataFrame([row], SCHEMAS["runs"]), root, "runs", ["run_id", "seq"])


def task_statuses(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The run's tasks with the status that the store says: failed, the sample's, validating with a
    generation, else pending."""
    tasks = stored(spark, root, "tasks").filter(F.col("run_id") == run_id)
    done = first_per_key(stored(spark, root, "samples").select("task_id", F.col("status").alias("_s"), "sample_id"), ["task_id"], [F.col("sample_id")])
    begun = stored(spark, root, "generations").select("task_id", F.lit(True).alias("_g")).distinct()
    status = F.coalesce("_s", F.when(F.col("_g"), "validating"), F.lit("pending"))
    out = tasks.join(done.drop("sample_id"), "task_id", "left").join(begun, "task_id", "left").withColumn("status", status).drop("_s", "_g")
    out = fail_tasks(out, stored(spark, root, "failures"))
    return out.drop("rejected_fail")


def due(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """H3 + F2: the run's unfinished tasks with their evidence and the stage to go on from; the
    queue order is ``position``, then the task's id."""
    return resume_items(task_statuses(spark, root, run_id), stored(spark, root, "generations"), stored(spark, root, "validation_results"),
                        stored(spark, root, "samples"))


def open_run(spark: SparkSession, root: str, branch: Branch) -> str:
    """The branch's open run, or a new one; wrong models and counts raise before any write."""
    preflight_model(stored(spark, root, "model_registry"), branch.model_id, branch.branch_id)
    total = branch.source.count()
    runs = run_log(spark, root)
    mine = runs.filter((F.col("model_id") == branch.model_id) & (F.col("dataset_id") == branch.dataset_id) & (F.col("config_id") == branch.config_id))
    found = latest_resumable_run(mine).first()
    if found is not None:
        resume_match(mine.filter(F.col("run_id") == found["run_id"]).first()["total_items"], total)
        return found["run_id"]
    run_id = f"RU00{_next(runs, 'run_id'):04d}"
    row = (run_id, 0, branch.model_id, branch.dataset_id, branch.config_id, total, "created", None)
    _append(spark, spark.createDataFrame([row], SCHEMAS["runs"]), root, "runs", ["run_id", "seq"])
    return run_id


def _import(spark: SparkSession, root: str, branch: Branch, run_id: str) -> None:
    held = stored(spark, root, "tasks")
    mine = held.filter(F.col("run_id") == run_id).select(F.col("source_id").alias("_held"))
    items = branch.source.join(mine, F.trim("source_id") == F.col("_held"), "left_anti")
    items = assign_ids(items, "TA00", [F.col("position"), F.col("source_id")], _next(held, "task_id"), "task_id")
    import_tasks_once(spark, _shaped(items.withColumn("run_id", F.lit(run_id)), "tasks"), root, [F.col("task_id")])


def _execute(spark: SparkSession, root: str, branch: Branch, tasks: DataFrame) -> None:
    results = branch.execute(tasks).checkpoint(eager=True)  # a model is asked once per task and stage
    lost = results.filter(F.col("error_type").isNotNull()).withColumns({"failure_seq": F.lit(0), "error_traceback": F.lit("")})
    _append(spark, lost, root, "failures", ["task_id"])
    good = results.filter(F.col("error_type").isNull()).join(tasks.select("task_id", "position"), "task_id")
    good = assign_ids(good, "GE00", [F.col("position"), F.col("task_id")], _next(stored(spark, root, "generations"), "generation_id"), "generation_id")
    _append(spark, good, root, "generations")


def accepted_before(spark: SparkSession, root: str, branch: Branch) -> DataFrame:
    """The dataset's accepted samples with their outputs, inputs and embeddings."""
    s = stored(spark, root, "samples").filter((F.col("status") == codes.ACCEPTED) & (F.col("dataset_id") == branch.dataset_id))
    g = stored(spark, root, "generations").select("generation_id", "raw_output", "parsed_output")
    t = stored(spark, root, "tasks").select("task_id", "input_payload")
    e = stored(spark, root, "embeddings").filter(F.col("source_type") == "generation").select(F.col("source_id").alias("generation_id"), "embedding")
    return s.select("sample_id", "task_id", "generation_id", "dataset_id").join(g, "generation_id").join(t, "task_id").join(e, "generation_id", "left")


def _evaluate(spark: SparkSession, root: str, branch: Branch, items: DataFrame) -> None:
    outputs = stored(spark, root, "generations").select("generation_id", "raw_output", "parsed_output", "metadata")
    rows = items.join(outputs, "generation_id").withColumn("dataset_id", F.lit(branch.dataset_id))
    verdicts = branch.evaluate(rows, accepted_before(spark, root, branch)).checkpoint(eager=True)
    if branch.embedding_model is not None:
        vectors = verdicts.filter(F.col("embedding").isNotNull()).select(
            F.concat(F.lit("EM"), F.substring("generation_id", 3, 64)).alias("embedding_id"), F.lit("generation").alias("source_type"),
            F.col("generation_id").alias("source_id"), F.lit(branch.embedding_model).alias("embedding_model_id"), "embedding")
        append_embeddings_once(spark, vectors, root)
    verdicts = verdicts.join(items.select("generation_id", "position"), "generation_id")
    verdicts = verdicts.withColumns({"is_valid": F.col("status") == codes.ACCEPTED, "validator_version": F.lit(branch.validator_version)})
    verdicts = verdicts.withColumnRenamed("details", "validation_details")
    numbered = assign_ids(verdicts, "VA00", [F.col("position"), F.col("generation_id")],
                          _next(stored(spark, root, "validation_results"), "validation_id"), "validation_id")
    _append(spark, numbered, root, "validation_results")


def _finalize(spark: SparkSession, root: str, branch: Branch, run_id: str, items: DataFrame) -> None:
    v = stored(spark, root, "validation_results")
    status = F.when(F.col("is_valid"), F.lit(codes.ACCEPTED)).otherwise(F.lit(codes.REJECTED))
    verdicts = items.select("task_id", "generation_id", "validation_id").join(
        v.select("validation_id", status.alias("status"), F.when(F.col("is_valid"), F.col("score")).alias("score"), "failure_code", "failure_reason"), "validation_id")
    fresh, _, conflicts = finalize(task_statuses(spark, root, run_id), verdicts, stored(spark, root, "samples"))
    assert_empty(conflicts, "finalize")
    fixed = {c: F.lit(x) for c, x in (("run_id", run_id), ("model_id", branch.model_id), ("dataset_id", branch.dataset_id),
                                      ("selector_version", branch.selector_version), ("metadata", "{}"))}
    _append(spark, fresh.withColumns({**fixed, "created_at": F.current_timestamp()}), root, "samples")


def run_branch(spark: SparkSession, root: str, branch: Branch, stop_after: str | None = None) -> str:
    """Do what is due of the branch's run and close it; the run's id.

    ``stop_after`` ends after a stage of ``STAGES``, as a stop there would; calling again goes on."""
    run_id = open_run(spark, root, branch)
    _import(spark, root, branch, run_id)
    if run_log(spark, root).filter(F.col("run_id") == run_id).first()["status"] == "created":
        _transition(spark, root, run_id, "running")
    if stop_after == "import":
        return run_id
    pending = None  # what is due changes only by a stage's work
    for stage, name, work in (("execute", "execute", lambda x: _execute(spark, root, branch, x)),
                              ("validate", "evaluate", lambda x: _evaluate(spark, root, branch, x)),
                              ("finalize", "finalize", lambda x: _finalize(spark, root, branch, run_id, x))):
        pending = due(spark, root, run_id).checkpoint(eager=True) if pending is None else pending
        items = pending.filter(F.col("resume_stage") == stage)
        if not items.isEmpty():
            work(items)
            pending = None
        if stop_after == name:
            return run_id
    counters = run_counters(task_statuses(spark, root, run_id))
    assert_empty(counter_violations(counters), "run counters")
    out = run_outcome(counters).first()
    status, error = ("completed", None) if out is None else (out["run_status"], out["error_message"])
    _transition(spark, root, run_id, status, error)
    return run_id


def publish_dataset(spark: SparkSession, root: str, out: str, branch: Branch, records: Callable[[DataFrame], DataFrame]) -> str:
    """A7 + A8 + C8: all finalized samples of the branch's dataset as golden and rejected lines, in
    order of their ids.  The scan's and the records' checks always run first; a new manifest makes
    both parts visible together."""
    runs = run_log(spark, root)
    scan = export_scan(stored(spark, root, "samples"), stored(spark, root, "tasks"), stored(spark, root, "generations"),
                       stored(spark, root, "validation_results"), runs, stored(spark, root, "model_registry"), branch.branch_id, branch.dataset_id)
    scan = scan.checkpoint(eager=True)  # what is checked is what is written
    assert_empty(consistency_violations(scan, branch.branch_id, branch.dataset_id), "export consistency")
    lines = records(scan).checkpoint(eager=True)
    assert_empty(lines.filter(F.col("problem").isNotNull()), "export records")
    log = stored(spark, root, "runs")
    assert_empty(illegal_transitions(log, "run_id", "seq", "status", "run"), "run transitions")
    part = lambda status: lines.filter(F.col("sample_status") == status)
    return publish(spark, {"golden": part(codes.ACCEPTED), "rejected": part(codes.REJECTED)}, out)
