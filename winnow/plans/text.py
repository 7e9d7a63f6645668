"""Text queries: prompt rendering, identifiers, task-source rules
(A1, B1, B9, B10, B15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import assign_ids, non_blank, parse_id, render_turns
from ..session import read_table
from .registry import query


@query("render_messages", """
SELECT conv_id,
       string_agg('<' || role || '>' || chr(10) || text || chr(10) || '</' || role || '>', chr(10) ORDER BY turn) AS rendered
FROM conversations GROUP BY conv_id
""")
def render_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: each conversation's turns rendered as one prompt, in turn order."""
    conv = read_table(spark, sf_dir, "conversations")
    return render_turns(conv, "conv_id", "turn", "role", "text")


ID_PREFIX = "ORDR"


@query("assign_ids", f"""
SELECT o_orderkey,
       '{ID_PREFIX}' || CASE WHEN row_number() OVER (ORDER BY o_orderkey) - 1 < 10000
                     THEN lpad(CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS VARCHAR), 4, '0')
                     ELSE CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS VARCHAR) END AS id
FROM orders
""")
def assign_ids_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive identifiers in key order, zero-padded to 4 digits."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    return assign_ids(o, ID_PREFIX, ["o_orderkey"], 0, "id").select("o_orderkey", "id")


@query("parse_ids", f"""
SELECT o_orderkey, substring(id, 1, 2) AS grp, substring(id, 3, 2) AS kind,
       CAST(substring(id, 5) AS BIGINT) AS counter
FROM (@assign_ids@)
""")
def parse_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B15 parse: group, kind and counter back from each identifier."""
    ids = assign_ids_q(spark, sf_dir)
    p = parse_id(F.col("id"))
    return ids.select("o_orderkey", p["group"].alias("grp"), p["kind"].alias("kind"), p["counter"].alias("counter"))


@query("source_rules", """
WITH d AS (
  SELECT doc_id, md5(text) AS task_id, text AS prompt,
         row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents)
SELECT doc_id,
       CASE WHEN task_id IS NULL OR regexp_replace(task_id, '^\\s+|\\s+$', '', 'g') = '' THEN 'blank_task_id'
            WHEN prompt IS NULL OR regexp_replace(prompt, '^\\s+|\\s+$', '', 'g') = '' THEN 'blank_prompt'
            WHEN rn > 1 THEN 'duplicate_task_id' END AS problem
FROM d
""")
def source_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read as task lines (task_id = MD5 of the text,
    prompt = text): non-blank id and prompt over the whole text; a repeated
    id is an error on every line after the first.  The text is looked at in
    the scan only; ids and one flag are shuffled, and only ids that repeat
    are joined back."""
    d = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.md5("text").alias("task_id"), non_blank("text").alias("has_prompt"))
    firsts = d.groupBy("task_id").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.filter("n > 1").select("task_id", "first").checkpoint(eager=True)
    problem = (F.when(~non_blank("task_id"), F.lit("blank_task_id"))
               .when(~F.col("has_prompt"), F.lit("blank_prompt"))
               .when(F.col("doc_id") != F.col("first"), F.lit("duplicate_task_id")))
    return d.join(firsts, "task_id", "left").select("doc_id", problem.alias("problem"))
