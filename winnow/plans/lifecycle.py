"""Lifecycle queries: resume evidence chains on orders -> lineitem, latest
open run, transition legality on events (D4, F1, H1, H2, H3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lifecycle import illegal_transitions, latest_resumable_run, resume_items
from ..session import read_table
from .registry import query


def store_from_orders(spark: SparkSession, sf_dir: str):
    """orders as tasks, lineitems as generations; a lineitem with line status
    F has a validation, and a returned (R) validated lineitem has a sample."""
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                      "l_linestatus", "l_returnflag")
    tasks = o.select(F.col("o_orderkey").alias("task_id"),
                     F.when(F.col("o_orderstatus") == "F", F.lit("accepted"))
                     .when(F.col("o_orderstatus") == "O", F.lit("pending"))
                     .otherwise(F.lit("validating")).alias("status"))
    # (orderkey, linenumber) repeats; the padded text id orders as (line, part, supplier)
    gid = F.concat_ws("-", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"),
                      F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
                      F.lpad(F.col("l_partkey").cast("string"), 10, "0"),
                      F.lpad(F.col("l_suppkey").cast("string"), 10, "0"))
    gens = li.select(gid.alias("generation_id"), F.col("l_orderkey").alias("task_id"), "l_linestatus", "l_returnflag")
    vals = gens.filter(F.col("l_linestatus") == "F").select(F.col("generation_id").alias("validation_id"), "generation_id")
    samples = gens.filter((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R")) \
        .select(F.col("generation_id").alias("sample_id"), "generation_id", "task_id")
    return tasks, gens.select("generation_id", "task_id"), vals, samples


RESUME_SQL = """
WITH t AS (
  SELECT o_orderkey AS task_id,
         CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'pending' ELSE 'validating' END AS status
  FROM orders),
g AS (
  SELECT l_orderkey AS task_id,
         lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || '-'
           || lpad(CAST(l_partkey AS VARCHAR), 10, '0') || '-' || lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS generation_id,
         l_linestatus, l_returnflag
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1)
SELECT t.task_id, t.status, g.generation_id,
       CASE WHEN g.l_linestatus = 'F' THEN g.generation_id END AS validation_id,
       CASE WHEN g.l_linestatus = 'F' AND g.l_returnflag = 'R' THEN g.generation_id END AS sample_id,
       CASE WHEN g.l_linestatus = 'F' AND g.l_returnflag = 'R' THEN 'complete'
            WHEN g.l_linestatus = 'F' THEN 'finalize'
            WHEN g.generation_id IS NOT NULL THEN 'validate' ELSE 'execute' END AS resume_stage
FROM t LEFT JOIN g ON t.task_id = g.task_id
"""


@query("resume_items", f"SELECT * FROM ({RESUME_SQL}) WHERE status IN ('pending', 'generating', 'validating')")
def resume_items_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3 + D4: unfinished tasks with first generation/validation/sample."""
    tasks, gens, vals, samples = store_from_orders(spark, sf_dir)
    r = resume_items(tasks, gens, vals, samples)
    return r.select("task_id", "status", "generation_id", "validation_id", "sample_id", "resume_stage")


@query("resume_stage", f"""
SELECT resume_stage, CAST(count(*) AS BIGINT) AS n_tasks FROM ({RESUME_SQL}) GROUP BY resume_stage
""")
def resume_stage_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2 over every task: how many resume from each stage."""
    tasks, gens, vals, samples = store_from_orders(spark, sf_dir)
    r = resume_items(tasks, gens, vals, samples, unfinished=("pending", "generating", "validating", "accepted",
                                                             "rejected", "failed"))
    return r.groupBy("resume_stage").agg(F.count(F.lit(1)).alias("n_tasks"))


@query("latest_resumable_run", """
SELECT o_custkey AS customer, max(o_orderkey) AS run_id
FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY o_custkey
""")
def latest_resumable_run_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """per customer the open (O = created, P = running) order with the highest key."""
    o = read_table(spark, sf_dir, "orders")
    runs = o.select(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("run_id"),
                    F.when(F.col("o_orderstatus") == "O", "created").when(F.col("o_orderstatus") == "P", "running")
                    .otherwise("completed").alias("status"))
    return latest_resumable_run(runs, ["customer"], "run_id")


# allowed event-type transitions (a session may start anywhere)
EVENT_FLOW = (("view", "view"), ("view", "click"), ("view", "signup"), ("view", "error"),
              ("click", "view"), ("click", "click"), ("click", "purchase"), ("click", "error"),
              ("purchase", "view"), ("purchase", "click"), ("signup", "view"), ("signup", "click"),
              ("error", "view"), ("error", "error"))


@query("illegal_transitions", """
WITH s AS (
  SELECT user_id, event_id, event_type AS to_status,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_status
  FROM events),
a(from_status, to_status) AS (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in EVENT_FLOW) + """)
SELECT s.user_id, s.event_id, s.from_status, s.to_status FROM s
WHERE s.from_status IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM a WHERE a.from_status = s.from_status AND a.to_status = s.to_status)
""")
def illegal_transitions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: consecutive event types per user that break the allowed flow."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    allowed = spark.createDataFrame(list(EVENT_FLOW), "from_status string, to_status string")
    bad = illegal_transitions(ev, "user_id", ["ts", "event_id"], "event_type", allowed=allowed)
    return bad.select("user_id", "event_id", "from_status", "to_status")
