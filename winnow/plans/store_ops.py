"""Store and lifecycle operators through the library functions, on stores derived from the
given tables (A1, A2, A4-A6, B4, B10, B12, B14, B19, B20, C6, C7, C10, D2, E2, E4, F4, F5, H4, H5, H6)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.jsonops import has_non_finite, promote_field
from ..functions.text import bounded_text, model_identity
from ..operators.dedup import exact_greedy_dedup
from ..operators.evaluate import evaluate_ml
from ..operators.lifecycle import apply_counter_deltas, counter_violations, fail_tasks, finalize, run_counters
from ..operators.reports import counts_by_pattern
from ..operators.validate import RegressionSettings, decision_violations, task_error_violations
from ..session import read_table, shared_dir
from ..sources.export import relative_path_ok
from ..sources.store import append_once, lookup, read_store
from ..sources.tasks import load_llm_tasks, load_ml_tasks
from .registry import query


@query("exact_dedup_prior", """
WITH prior AS (SELECT user_id, event_type, min(event_id) AS held FROM events WHERE event_id % 10 = 0 GROUP BY 1, 2),
c AS (SELECT *, first_value(event_id) OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS first_id FROM events WHERE event_id % 10 <> 0)
SELECT c.event_id, coalesce(prior.held, CASE WHEN c.event_id <> first_id THEN first_id END) AS duplicate_of,
       CASE WHEN prior.held IS NOT NULL OR c.event_id <> first_id THEN 'duplicate_sample' END AS failure_code
FROM c LEFT JOIN prior ON c.user_id = prior.user_id AND c.event_type = prior.event_type
""")
def exact_dedup_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + D2 + F4: every tenth event is already accepted; a match names the lowest accepted id."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    held = F.col("event_id") % 10 == 0
    out = exact_greedy_dedup(ev.filter(~held), ["user_id", "event_type"], [-F.col("value")], "event_id", accepted=ev.filter(held))
    return out.select("event_id", "duplicate_of", F.col("dedup_code").alias("failure_code"))


@query("evaluate_ml_events", """
WITH s AS (@select_regression_events@)
SELECT event_id, status, failure_code, score, duplicate_of,
       CASE WHEN failure_code IS NULL OR failure_code = 'duplicate_sample' THEN ['ml_validation', 'ml_exact_dedup'] ELSE ['ml_validation'] END AS checks
FROM s
""")
def evaluate_ml_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 through ``evaluate_ml``: rule, exact dedup, evidence of the stages that ran."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.lit("d").alias("dataset_id"), F.lit(codes.REGRESSION).alias("mode"),
        F.lit("p").alias("pipeline_id"), F.col("value").alias("prediction"))
    out = evaluate_ml(ev, RegressionSettings(10.0, 400.0), ["user_id", "event_type"], "event_id", order=[-F.col("value")])
    return out.select("event_id", "status", "failure_code", "score", "duplicate_of", F.transform("evidence", lambda e: e["check_id"]).alias("checks"))


def _written_lines(spark: SparkSession, lines: DataFrame) -> str:
    path = shared_dir(spark, f"task-lines-{uuid.uuid4().hex}")
    lines.write.text(path)
    return path


_LLM_CASES = """CASE doc_id % 8 WHEN 2 THEN 'exactly one of prompt or messages is required' WHEN 3 THEN 'exactly one of prompt or messages is required'
  WHEN 4 THEN 'unknown keys: extra' WHEN 5 THEN 'invalid expected_schema: unsupported JSON Schema keyword ''anyOf''' WHEN 6 THEN 'invalid JSON' END"""


@query("load_llm_tasks", f"""
SELECT CASE WHEN p IS NULL THEN 'task ' || doc_id END AS task_id, p AS problem, CAST(count(*) AS BIGINT) AS n
FROM (SELECT doc_id, {_LLM_CASES} AS p FROM documents) GROUP BY ALL
""")
def load_llm_tasks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + B10: task lines written from documents, good and bad, read back."""
    k, i = F.col("doc_id") % 8, F.col("doc_id").cast("string")
    head = F.concat(F.lit('{"task_id":" task '), i, F.lit(' ",'))
    schema = F.lit('"expected_schema":{"type":"object","required":["n"]}}')
    msgs = F.lit('"messages":[{"role":"user","content":"x"}],')
    body = (F.when(k == 1, F.concat(F.lit('"prompt":null,'), msgs, schema)).when(k == 2, F.concat(F.lit('"prompt":"p",'), msgs, schema))
            .when(k == 3, F.concat(F.lit('"prompt":null,"messages":null,'), schema)).when(k == 4, F.concat(F.lit('"extra":1,"prompt":"p",'), schema))
            .when(k == 5, F.lit('"prompt":"p","expected_schema":{"anyOf":[]}}')).when(k == 6, F.lit('"prompt":}'))
            .otherwise(F.concat(F.lit('"prompt":"p",'), schema)))
    path = _written_lines(spark, read_table(spark, sf_dir, "documents").select(F.concat(head, body).alias("value")))
    good, bad = load_llm_tasks(spark, path, "permissive")
    rows = good.select("task_id", F.lit(None).cast("string").alias("problem")).unionByName(
        bad.select(F.lit(None).cast("string").alias("task_id"), "problem"))
    return rows.groupBy("task_id", "problem").agg(F.count(F.lit(1)).alias("n"))


@query("load_ml_tasks", """
SELECT CASE WHEN p IS NULL THEN 'o' || o_orderkey END AS task_id, p AS problem, CAST(count(*) AS BIGINT) AS n
FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 1 THEN 'task_id must be a non-blank string' WHEN 2 THEN 'Feature price must have type float' END AS p FROM orders)
GROUP BY ALL
""")
def load_ml_tasks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + B8: numeric ids and features of another type are errors of their lines."""
    k, i = F.col("o_orderkey") % 4, F.col("o_orderkey").cast("string")
    task = F.when(k == 1, i).otherwise(F.concat(F.lit('"o'), i, F.lit('"')))
    line = F.concat(F.lit('{"task_id":'), task, F.lit(',"features":{"price":'), F.when(k == 2, F.lit("7")).otherwise(F.lit("7.5")), F.lit("}}"))
    path = _written_lines(spark, read_table(spark, sf_dir, "orders").select(line.alias("value")))
    good, bad = load_ml_tasks(spark, path, (("price", "float"),), "permissive")
    rows = good.select("task_id", F.lit(None).cast("string").alias("problem")).unionByName(
        bad.select(F.lit(None).cast("string").alias("task_id"), "problem"))
    return rows.groupBy("task_id", "problem").agg(F.count(F.lit(1)).alias("n"))


def _order_store(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """orders as tasks with a verdict each; every third has a sample from before."""
    o, k = read_table(spark, sf_dir, "orders"), F.col("o_orderkey")
    tid = F.format_string("TA%010d", k)
    tasks = o.select(tid.alias("task_id"), F.when(k % 5 == 0, "generating").when(k % 7 == 0, "accepted").otherwise("validating").alias("status"))
    verdict = F.when(k % 2 == 0, F.lit("accepted")).otherwise(F.lit("rejected"))
    verdicts = o.select(tid.alias("task_id"), F.format_string("GE%010d", k).alias("generation_id"), verdict.alias("status"))
    samples = o.filter(k % 3 == 0).select(F.format_string("SA00%d", k).alias("sample_id"), F.format_string("GE%010d", k).alias("generation_id"),
                                          F.when(k % 11 == 0, F.lit("accepted")).otherwise(verdict).alias("status"))
    return tasks, verdicts, samples


_FINALIZE_SQL = """
WITH t AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'generating' WHEN o_orderkey % 7 = 0 THEN 'accepted' ELSE 'validating' END AS ts,
         CASE WHEN o_orderkey % 2 = 0 THEN 'accepted' ELSE 'rejected' END AS vs FROM orders),
j AS (SELECT *, CASE WHEN k % 3 = 0 THEN CASE WHEN k % 11 = 0 THEN 'accepted' ELSE vs END END AS ss FROM t),
c AS (
  SELECT *, CASE WHEN ss <> vs THEN 'sample status conflicts with validation'
                 WHEN ss IS NOT NULL AND ts IN ('accepted', 'rejected') AND ts <> ss THEN 'task status conflicts with sample'
                 WHEN ss IS NULL AND ts <> 'validating' THEN 'illegal task transition' END AS conflict FROM j),
n AS (SELECT k, row_number() OVER (ORDER BY k) + (SELECT max(k) FROM j WHERE ss IS NOT NULL) AS number FROM c WHERE conflict IS NULL AND ss IS NULL)
"""


@query("finalize_tasks", _FINALIZE_SQL + """
SELECT 'TA' || lpad(CAST(c.k AS VARCHAR), 10, '0') AS task_id, CASE WHEN conflict IS NULL THEN coalesce(ss, vs) ELSE ts END AS status, conflict,
       CASE WHEN n.number IS NOT NULL THEN 'SA00' || CASE WHEN n.number < 10000 THEN lpad(CAST(n.number AS VARCHAR), 4, '0') ELSE CAST(n.number AS VARCHAR) END END AS new_sample
FROM c LEFT JOIN n ON c.k = n.k
""")
def finalize_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4 + B15: new samples numbered on from the store, repaired tasks, conflicts."""
    tasks, verdicts, samples = _order_store(spark, sf_dir)
    fresh, out, conflicts = finalize(tasks, verdicts, samples)
    return out.join(fresh.select("task_id", F.col("sample_id").alias("new_sample")), "task_id", "left").join(
        conflicts.select("task_id", "conflict"), "task_id", "left").select("task_id", "status", "conflict", "new_sample")


@query("fail_tasks", """
SELECT 'TA' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS task_id,
       CASE WHEN o_orderkey % 4 = 0 AND (o_orderkey % 5 = 0 OR o_orderkey % 7 <> 0) THEN 'failed'
            WHEN o_orderkey % 5 = 0 THEN 'generating' WHEN o_orderkey % 7 = 0 THEN 'accepted' ELSE 'validating' END AS status,
       CASE WHEN o_orderkey % 4 = 0 AND (o_orderkey % 5 = 0 OR o_orderkey % 7 <> 0) THEN 'first of ' || o_orderkey END AS error_message,
       o_orderkey % 4 = 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 = 0 AS rejected_fail
FROM orders
""")
def fail_tasks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: the first of two failures is kept; a finalized task cannot fail."""
    tasks, _, _ = _order_store(spark, sf_dir)
    k = F.col("o_orderkey")
    failed = read_table(spark, sf_dir, "orders").filter(k % 4 == 0).select("o_orderkey", F.explode(F.array(F.lit(2), F.lit(1))).alias("failure_seq"))
    failures = failed.select(F.format_string("TA%010d", k).alias("task_id"), "failure_seq", F.lit("ValueError").alias("error_type"),
                             F.concat(F.when(F.col("failure_seq") == 1, "first of ").otherwise("second of "), k.cast("string")).alias("error_message"),
                             F.lit("").alias("error_traceback"))
    return fail_tasks(tasks, failures).select("task_id", "status", "error_message", "rejected_fail")


@query("decision_violations", """
SELECT event_id FROM events WHERE event_id % 6 IN (1, 2, 3, 5)
""")
def decision_violations_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted with a code or a reason, rejected without a code."""
    k = F.col("event_id") % 6
    d = read_table(spark, sf_dir, "events").select(
        "event_id", F.when(k.isin(0, 1, 2), "accepted").otherwise("rejected").alias("status"),
        F.when(k.isin(1, 4), "code").alias("failure_code"), F.when(k.isin(2, 4), "why").alias("failure_reason"))
    return decision_violations(d).select("event_id")


@query("task_error_violations", """
SELECT event_id FROM events WHERE event_id % 5 IN (1, 2, 4)
""")
def task_error_violations_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error evidence all or none, a source id not blank."""
    k = F.col("event_id") % 5
    t = read_table(spark, sf_dir, "events").select(
        "event_id", F.when(k.isin(1, 3), "E").alias("error_type"), F.when(k.isin(2, 3), "m").alias("error_message"), F.when(k == 3, "t").alias("error_traceback"),
        F.when(k == 4, "  ").otherwise("s").alias("source_id"))
    return task_error_violations(t).select("event_id")


@query("counter_deltas", """
WITH t AS (SELECT o_custkey AS run_id, CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'P' THEN 'rejected' ELSE 'pending' END AS st FROM orders)
SELECT run_id, CAST(count(*) AS BIGINT) AS total_items, CAST(count(*) FILTER (st <> 'pending') + 2 * count(*) FILTER (st = 'pending') AS BIGINT) AS processed_items,
       CAST(count(*) FILTER (st = 'accepted') AS BIGINT) AS accepted_items, CAST(count(*) FILTER (st = 'rejected') AS BIGINT) AS rejected_items,
       CAST(2 * count(*) FILTER (st = 'pending') AS BIGINT) AS failed_items, count(*) FILTER (st = 'pending') > 0 AS broken
FROM t GROUP BY run_id
""")
def counter_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + E2: counters, two deltas per open item (one too many, which the check names)."""
    status = F.when(F.col("o_orderstatus") == "F", "accepted").when(F.col("o_orderstatus") == "P", "rejected").otherwise("pending")
    t = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run_id"), status.alias("status"))
    one = t.filter("status = 'pending'").select("run_id", *[F.lit(n).cast("long").alias(c) for c, n in (
        ("processed_items", 1), ("accepted_items", 0), ("rejected_items", 0), ("failed_items", 1))])
    out = apply_counter_deltas(run_counters(t), one.unionByName(one))
    bad = counter_violations(out).select("run_id", F.lit(True).alias("broken"))
    return out.join(bad, "run_id", "left").select(
        "run_id", "total_items", "processed_items", "accepted_items", "rejected_items", "failed_items", F.coalesce("broken", F.lit(False)).alias("broken"))


@query("counts_by_pattern", """
SELECT 'customer' AS "table", count(*) AS n FROM customer WHERE CAST(c_custkey AS VARCHAR) LIKE '%7%'
UNION ALL SELECT 'orders', count(*) FROM orders WHERE CAST(o_orderkey AS VARCHAR) LIKE '%7%'
UNION ALL SELECT 'part', count(*) FROM part WHERE CAST(p_partkey AS VARCHAR) LIKE '%7%'
""")
def counts_by_pattern_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table by id pattern."""
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey"}
    return counts_by_pattern({t: (read_table(spark, sf_dir, t), k) for t, k in keys.items()}, "%7%")


@query("store_appends", """
SELECT o_custkey AS task_id, min(o_orderkey) AS generation_id FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1
UNION ALL
SELECT o_custkey, min(o_orderkey) FROM orders WHERE o_orderkey % 3 <> 0 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0) GROUP BY 1
""")
def store_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: two batches and a repeat are written; the first row per key stays."""
    root = shared_dir(spark, f"appends-{uuid.uuid4().hex}")
    o = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("task_id"), F.col("o_orderkey").alias("generation_id"))
    third = F.col("generation_id") % 3 == 0
    for batch in (o.filter(third), o.filter(~third), o.filter(third)):
        append_once(spark, batch, root, "generations", order=[F.col("generation_id")])
    return read_store(spark, root, "generations").select("task_id", "generation_id")


@query("key_lookup", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 9 = 0)
""")
def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups by key as one semi join."""
    c = read_table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 9 == 0).select(F.col("c_custkey").alias("o_custkey"))
    return lookup(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", c)


@query("text_rules", """
WITH e AS (SELECT event_id, event_id % 4 AS k FROM events)
SELECT event_id, CASE k WHEN 0 THEN 'm' WHEN 1 THEN 'm:latest' WHEN 2 THEN 'm:v' || event_id ELSE 'n' END AS model,
       CASE WHEN k = 1 THEN repeat('y', 6) || '...[truncated]' ELSE 'short' END AS bounded,
       k = 2 AS non_finite, k <> 3 AS relative, 'E' || event_id AS error_type, '{"k":' || k || '}' AS rest
FROM e
""")
def text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4, B12, B14, B19, B20 as columns."""
    k, i = F.col("event_id") % 4, F.col("event_id").cast("string")
    model = F.when(k == 0, F.lit(" m:latest ")).when(k == 1, F.lit("m:latest:latest")).when(k == 2, F.concat(F.lit("m:v"), i)).otherwise(F.lit("n"))
    text = F.when(k == 1, F.repeat(F.lit("y"), 40)).otherwise(F.lit("short"))
    number = F.when(k == 2, F.lit('{"a":"1e999","b":[-1e999]}')).otherwise(F.lit('{"a":"1e999","b":1e9}'))
    e = read_table(spark, sf_dir, "events").select(
        "event_id", model.alias("m"), text.alias("t"), number.alias("j"), F.when(k == 3, "/abs/x").otherwise("rel/x").alias("p"),
        F.concat(F.lit('{"error_type":"E'), i, F.lit('","k":'), k.cast("string"), F.lit("}")).alias("doc"))
    value, rest = promote_field(F.col("doc"), "error_type")
    return e.select("event_id", model_identity("m").alias("model"), bounded_text(F.col("t"), 20).alias("bounded"), has_non_finite("j").alias("non_finite"),
                    relative_path_ok(F.col("p")).alias("relative"), value.alias("error_type"), rest.alias("rest"))
