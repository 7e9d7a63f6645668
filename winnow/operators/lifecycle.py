"""Lifecycle and resume as table transformations
(D4, D5, E1, E2, F1, F2, H1-H7).

The reference walks tasks one at a time; here each rule is one DataFrame
step over all tasks.  Small fixed tables (legal transitions) are broadcast;
everything that grows with the data is aggregated or joined by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes


def transitions_table(spark: SparkSession, kind: str) -> DataFrame:
    pairs = codes.RUN_TRANSITIONS if kind == "run" else codes.TASK_TRANSITIONS
    return spark.createDataFrame(list(pairs), "from_status string, to_status string")


def skew_safe_lag(df: DataFrame, key: str, order: Sequence[str], value: str, out: str = "prev",
                  n_parts: int | None = None) -> DataFrame:
    """``lag(value) over (partition by key order by order)`` that does not put
    a hot key into one task.

    Rows are range-partitioned on (key, order), so a key holding a third of
    all rows spans many partitions.  Inside a partition the lag is a window
    over (partition id, key); the first row of each chunk takes the last
    value of the same key from the chunk before it (a lag over one small row
    per chunk)."""
    spark = df.sparkSession
    n_parts = n_parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = [F.col(c) for c in order]
    ranged = df.repartitionByRange(n_parts, F.col(key), *ordered).withColumn("_pid", F.spark_partition_id())
    ranged = ranged.checkpoint(eager=True)  # partition ids must stay fixed for both uses below
    w = Window.partitionBy("_pid", key).orderBy(*ordered)
    local = ranged.withColumn(out, F.lag(value).over(w)).withColumn("_rn", F.row_number().over(w))
    tails = ranged.groupBy("_pid", key).agg(F.max_by(F.col(value), F.struct(*ordered)).alias("_tail"))
    # the chunk before: the highest partition id below this one that holds the key; one row
    # per key and partition
    prev = tails.withColumn("_carry", F.lag("_tail").over(Window.partitionBy(key).orderBy("_pid"))).drop("_tail")
    res = local.join(prev, ["_pid", key], "left")
    res = res.withColumn(out, F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col(out)))
    return res.drop("_pid", "_rn", "_carry")


def illegal_transitions(log: DataFrame, entity: str, order: Sequence[str] | str, status: str, kind: str = "task",
                        allowed: DataFrame | None = None) -> DataFrame:
    """H1 on a status log: each consecutive (previous, next) pair per entity
    that is not a legal transition.  The previous status comes from a
    skew-safe lag; the allowed table is tiny and broadcast."""
    spark = log.sparkSession
    order = [order] if isinstance(order, str) else list(order)
    allowed = allowed if allowed is not None else transitions_table(spark, kind)
    steps = skew_safe_lag(log, entity, order, status, "from_status") \
        .withColumn("to_status", F.col(status)).filter(F.col("from_status").isNotNull())
    # a fixed handful of rows
    return steps.join(F.broadcast(allowed), ["from_status", "to_status"], "left_anti")


def resume_stage(has_generation, has_validation, has_sample) -> Column:
    """H2: sample -> complete, validation -> finalize, generation -> validate, else execute."""
    g, v, s = (F.col(x) if isinstance(x, str) else x for x in (has_generation, has_validation, has_sample))
    return (F.when(s, F.lit("complete")).when(v, F.lit("finalize")).when(g, F.lit("validate"))
            .otherwise(F.lit("execute")))


def id_order(df: DataFrame, id_col: str) -> Column:
    """Insertion order of an id: by number, or for text ids (``GE009999`` before ``GE0010000``)
    by length and then text, so that a growing width does not reorder them."""
    if df.schema[id_col].dataType.simpleString() == "string":
        return F.struct(F.length(id_col).alias("_len"), F.col(id_col).alias("_id"))
    return F.struct(F.col(id_col).alias("_id"))


def first_child(children: DataFrame, parent_key: str, child_id: str, cols: Sequence[str] | None = None,
                prefix: str = "") -> DataFrame:
    """D4 (``LEFT JOIN LATERAL ... ORDER BY id LIMIT 1``) as a partial
    aggregate: one row per parent holding the child with the lowest id."""
    cols = list(cols) if cols else [c for c in children.columns if c != parent_key]
    packed = F.min_by(F.struct(*[F.col(c) for c in cols]), id_order(children, child_id))
    agg = children.groupBy(parent_key).agg(packed.alias("_first"))
    return agg.select(parent_key, *[F.col("_first")[c].alias(prefix + c) for c in cols])


def resume_items(tasks: DataFrame, generations: DataFrame, validations: DataFrame, samples: DataFrame,
                 unfinished: Sequence[str] = ("pending", "generating", "validating")) -> DataFrame:
    """H3: unfinished tasks, each with its first generation, that generation's
    first validation and first sample, and the stage to resume from."""
    t = tasks.filter(F.col("status").isin(*unfinished))
    g = first_child(generations.select("task_id", "generation_id"), "task_id", "generation_id")
    v = first_child(validations.select("generation_id", "validation_id"), "generation_id", "validation_id")
    s = first_child(samples.select("generation_id", "sample_id"), "generation_id", "sample_id")
    out = t.join(g, "task_id", "left").join(v, "generation_id", "left").join(s, "generation_id", "left")
    return out.withColumn("resume_stage", resume_stage(F.col("generation_id").isNotNull(),
                                                       F.col("validation_id").isNotNull(),
                                                       F.col("sample_id").isNotNull()))


def latest_resumable_run(runs: DataFrame, keys: Sequence[str] = ("model_id", "dataset_id", "config_id"),
                         id_col: str = "run_id", open_states: Sequence[str] = ("created", "running")) -> DataFrame:
    """per key the open run with the highest id (``max_by``, partial aggregate)."""
    open_runs = runs.filter(F.col("status").isin(*open_states))
    return open_runs.groupBy(*keys).agg(F.max_by(F.col(id_col), id_order(open_runs, id_col)).alias(id_col))


def run_counters(tasks: DataFrame, run_col: str = "run_id", status: str = "status") -> DataFrame:
    """Counters recomputed from task statuses (filtered counts)."""
    st = F.col(status)
    return tasks.groupBy(run_col).agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(st.isin(codes.ACCEPTED, codes.REJECTED, "failed")).alias("processed_items"),
        F.count_if(st == codes.ACCEPTED).alias("accepted_items"),
        F.count_if(st == codes.REJECTED).alias("rejected_items"),
        F.count_if(st == "failed").alias("failed_items"),
    )


def counter_violations(counters: DataFrame) -> DataFrame:
    """Accepted + rejected + failed <= processed <= total."""
    c = F.col
    return counters.filter(
        (c("accepted_items") + c("rejected_items") + c("failed_items") > c("processed_items"))
        | (c("processed_items") > c("total_items"))
        | (c("accepted_items") < 0) | (c("rejected_items") < 0) | (c("failed_items") < 0)
    )


def apply_counter_deltas(counters: DataFrame, deltas: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Add per-run deltas (summed first) to the counters."""
    names = ["processed_items", "accepted_items", "rejected_items", "failed_items"]
    d = deltas.groupBy(run_col).agg(*[F.sum(n).alias("_d_" + n) for n in names])
    out = counters.join(d, run_col, "left")
    for n in names:
        out = out.withColumn(n, F.col(n) + F.coalesce(F.col("_d_" + n), F.lit(0))).drop("_d_" + n)
    return out


def run_outcome(counters: DataFrame) -> DataFrame:
    """H6: any failed item -> failed, with an error naming the count."""
    failed = F.col("failed_items") > 0
    return counters.withColumn("run_status", F.when(failed, F.lit("failed")).otherwise(F.lit("completed"))) \
        .withColumn("error_message", F.when(failed, F.format_string("%d item(s) failed", F.col("failed_items"))))


def finalize(tasks: DataFrame, verdicts: DataFrame, samples: DataFrame, prefix: str = "SA00") -> tuple[DataFrame, DataFrame, DataFrame]:
    """H4: (new samples, tasks with their new status, conflicts) of a batch of verdicts.

    ``verdicts``: task_id, generation_id, status and whatever else a sample carries;
    ``samples``: the samples stored so far.  A generation that has a sample keeps it: the
    verdict must agree with it, and a task still generating or validating takes its status
    (the repair after a stop between the two writes).  Without one, a validating task takes the
    verdict and a sample is made, numbered on from the highest stored number (B15).  Anything
    else is a conflict and changes nothing; callers raise on it (``assert_empty``).
    """
    from ..functions.text import assign_ids, parse_id

    stored = first_child(samples.select("generation_id", "sample_id", F.col("status").alias("sample_status")), "generation_id", "sample_id")
    j = verdicts.join(stored, "generation_id", "left").join(
        tasks.select("task_id", F.col("status").alias("task_status")), "task_id", "left")
    has, t, s = F.col("sample_id").isNotNull(), F.col("task_status"), F.col("sample_status")
    final = t.isin(codes.ACCEPTED, codes.REJECTED)
    conflict = (F.when(t.isNull(), F.lit("unknown task"))
                .when(~F.col("status").isin(codes.ACCEPTED, codes.REJECTED), F.lit("unsupported sample status"))
                .when(has & (s != F.col("status")), F.lit("sample status conflicts with validation"))
                .when(has & final & (t != s), F.lit("task status conflicts with sample"))
                .when(has & ~final & ~t.isin("generating", "validating"), F.lit("illegal task transition"))
                .when(~has & (t != "validating"), F.lit("illegal task transition")))
    j = j.withColumn("conflict", conflict).checkpoint(eager=True)
    conflicts = j.filter(F.col("conflict").isNotNull()).select("task_id", "generation_id", "conflict")
    good = j.filter(F.col("conflict").isNull())
    top = samples.agg(F.max(parse_id(F.col("sample_id"))["counter"])).first()[0]
    fresh = good.filter(F.col("sample_id").isNull()).select(*verdicts.columns)
    fresh = assign_ids(fresh, prefix, ["task_id", "generation_id"], 0 if top is None else top + 1, "sample_id")
    decided = good.select("task_id", F.coalesce(s, F.col("status")).alias("_new")).dropDuplicates(["task_id"])
    out = tasks.join(decided, "task_id", "left").withColumn("status", F.coalesce("_new", "status")).drop("_new")
    return fresh, out, conflicts


def fail_tasks(tasks: DataFrame, failures: DataFrame) -> DataFrame:
    """H5: mark tasks failed with type/message/traceback.  A finalized task
    cannot fail (``rejected_fail``), a repeat is a no-op (first failure kept)."""
    from ..functions.text import bounded_text

    f = first_child(failures.select("task_id", "failure_seq", "error_type", "error_message", "error_traceback"),
                    "task_id", "failure_seq", ["error_type", "error_message", "error_traceback"], prefix="_f_")
    out = tasks.join(f, "task_id", "left")
    can_fail = F.col("_f_error_type").isNotNull() & F.col("status").isin("pending", "generating", "validating")
    out = out.withColumn("rejected_fail", F.col("_f_error_type").isNotNull() & F.col("status").isin(codes.ACCEPTED, codes.REJECTED))
    for c, lim in (("error_type", None), ("error_message", codes.ERROR_MESSAGE_LIMIT), ("error_traceback", codes.TRACEBACK_LIMIT)):
        val = F.col("_f_" + c) if lim is None else bounded_text(F.col("_f_" + c), lim)
        existing = F.col(c) if c in tasks.columns else F.lit(None).cast("string")
        out = out.withColumn(c, F.when(can_fail & existing.isNull(), val).otherwise(existing))
    out = out.withColumn("status", F.when(can_fail, F.lit("failed")).otherwise(F.col("status")))
    return out.drop("_f_error_type", "_f_error_message", "_f_error_traceback")


def preflight_model(model_registry: DataFrame, model_id: str, branch: str) -> None:
    """The model must exist with type = branch, else raise before any write."""
    rows = model_registry.filter(F.col("model_id") == model_id).select("model_type").limit(2).collect()
    if not rows:
        raise ValueError(f"model {model_id!r} is not registered")
    if rows[0]["model_type"] != branch:
        raise ValueError(f"model {model_id!r} has type {rows[0]['model_type']!r}, expected {branch!r}")


def resume_match(run_total: int, source_count: int) -> None:
    """H7: a resumed run must see the same number of source items."""
    if run_total != source_count:
        raise ValueError(f"resumable run has {run_total} items but the source has {source_count}")
