"""JSON queries over ``events`` and ``lineitem``."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import canonical_features, with_feature_problem
from ..functions.jsonops import canonical_json, json_depth, structured_json_gate
from ..operators.jsonschema import check_against_schemas
from ..session import read_table, spread
from .registry import query

MAX_CHARS = 64
MAX_DEPTH = 3


def damaged_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events.props plus damaged variants chosen by event_id, covering every gate code."""
    ev = spread(read_table(spark, sf_dir, "events").select("event_id", "props"))
    p = F.col("props")
    k = F.col("event_id") % 8
    text = (
        F.when(k == 1, F.expr("substring(props, 1, length(props) - 1)"))
        .when(k == 2, F.regexp_replace(p, '"', "'"))
        .when(k == 3, F.concat(F.lit('{"a":{"b":'), p, F.lit("}}")))
        .when(k == 4, F.concat(F.lit("["), p, F.lit("]")))
        .when(k == 5, F.lit("   "))
        .when(k == 6, F.repeat(p, 8))
        .when(k == 7, F.concat(p, F.lit(" x")))
        .otherwise(p)
    )
    return ev.select("event_id", text.alias("text"))


DAMAGED_SQL = """
SELECT event_id,
       CASE event_id % 8 WHEN 1 THEN substring(props, 1, length(props) - 1)
                         WHEN 2 THEN replace(props, '"', '''')
                         WHEN 3 THEN '{"a":{"b":' || props || '}}'
                         WHEN 4 THEN '[' || props || ']'
                         WHEN 5 THEN '   '
                         WHEN 6 THEN repeat(props, 8)
                         WHEN 7 THEN props || ' x'
                         ELSE props END AS text
FROM events"""

# depth in DuckDB: same reduction, then the running bracket count by prefixes
_RED = ("regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, "
        "'\"(?:[^\"\\\\]|\\\\.)*\"', 's', 'g'), '[^\\[\\]{}:,\\s]+', 's', 'g'), '[:,\\s]+', '', 'g'), "
        "'\\{\\}|\\[\\]', 's', 'g'), '[^\\[\\]{}]', '', 'g')")


@query("structured_json_gate", f"""
WITH d AS ({DAMAGED_SQL}),
r AS (SELECT event_id, text, {_RED} AS b FROM d),
g AS (
  SELECT event_id, text,
         CASE WHEN trim(text) = '' THEN 'empty_output'
              WHEN length(text) > {MAX_CHARS} THEN 'too_long_output'
              WHEN NOT json_valid(text) THEN 'invalid_json'
              WHEN json_type(text) <> 'OBJECT' THEN 'wrong_type' END AS pre,
         1 + coalesce(list_max(list_transform(range(1, length(b) + 1),
               lambda i: length(regexp_replace(left(b, i), '[\\]}}]', '', 'g'))
                  - length(regexp_replace(left(b, i), '[\\[{{]', '', 'g')))), 0) AS depth
  FROM r)
SELECT event_id,
       coalesce(pre, CASE WHEN depth > {MAX_DEPTH} THEN 'max_depth_exceeded' END) AS failure_code,
       CASE WHEN pre IS NULL THEN CAST(depth AS INTEGER) END AS depth,
       CASE WHEN pre IS NULL AND depth <= {MAX_DEPTH} THEN json(text)::VARCHAR END AS canonical
FROM g
""")
def structured_json_gate_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = damaged_props(spark, sf_dir)
    code = structured_json_gate(F.col("text"), MAX_CHARS, MAX_DEPTH)
    g = d.withColumn("failure_code", code)
    structural = F.col("failure_code").isNull() | (F.col("failure_code") == "max_depth_exceeded")
    return g.select(
        "event_id", "failure_code",
        F.when(structural, json_depth(F.col("text"))).cast("int").alias("depth"),
        F.when(F.col("failure_code").isNull(), canonical_json(F.col("text"))).alias("canonical"),
    )


@query("canonical_props", """
SELECT event_id,
       '{"event_type":' || to_json(event_type) || ',"props":' || json(props)::VARCHAR
         || ',"user_id":' || CAST(user_id AS VARCHAR) || '}' AS canonical
FROM events
""")
def canonical_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key-sorted compact rendering of a document built from three columns
    (user_id, event_type, props given in another key order)."""
    ev = read_table(spark, sf_dir, "events")
    doc = F.concat(F.lit('{"user_id":'), F.col("user_id").cast("string"), F.lit(',"props":'), F.col("props"),
                   F.lit(',"event_type":'), F.expr("substring(to_json(struct(event_type AS e)), 6)"))
    return ev.select("event_id", canonical_json(doc).alias("canonical"))


# one schema per event_type: the keywords the seed tasks and tests use
EVENT_SCHEMAS = {
    "view": {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 0, "maximum": 50}}},
    "click": {"type": "object", "required": ["k"], "additionalProperties": False,
              "properties": {"k": {"type": "integer", "exclusiveMinimum": 10, "exclusiveMaximum": 90}}},
    "error": {"type": "object", "required": ["k", "code"], "properties": {"k": {"type": "number", "maximum": 70}}},
    "purchase": {"type": "object", "properties": {"k": {"type": "integer", "multipleOf": 3}}, "minProperties": 1},
    "signup": {"type": "object", "properties": {"k": {"enum": [1, 2, 3, 5, 8, 13, 21, 34, 55, 89]}}},
}


def schema_table(spark: SparkSession) -> DataFrame:
    rows = [(k, json.dumps(v)) for k, v in sorted(EVENT_SCHEMAS.items())]
    return spark.createDataFrame(rows, "event_type string, expected_schema string")


@query("json_schema_check", """
WITH e AS (
  SELECT event_id, event_type, json_extract(props, '$.k') AS kj, json_type(props, '$.k') AS kt,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS kv
  FROM events),
c AS (
  SELECT event_id,
    CASE event_type
      WHEN 'view' THEN [kj IS NULL, kj IS NOT NULL AND kt NOT IN ('UBIGINT','BIGINT'),
                        kv IS NOT NULL AND kv < 0, kv IS NOT NULL AND kv > 50]
      WHEN 'click' THEN [kj IS NULL, kj IS NOT NULL AND kt NOT IN ('UBIGINT','BIGINT'),
                         kv IS NOT NULL AND kv <= 10, kv IS NOT NULL AND kv >= 90]
      WHEN 'error' THEN [kj IS NULL, TRUE, kj IS NOT NULL AND kt NOT IN ('UBIGINT','BIGINT','DOUBLE'),
                         kv IS NOT NULL AND kv > 70]
      WHEN 'purchase' THEN [FALSE, kj IS NOT NULL AND kt NOT IN ('UBIGINT','BIGINT'),
                            kv IS NOT NULL AND kv / 3 <> floor(kv / 3)]
      WHEN 'signup' THEN [FALSE, kj IS NOT NULL AND CAST(kj AS VARCHAR) NOT IN ('1','2','3','5','8','13','21','34','55','89')]
    END AS errs,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 1 WHEN 'error' THEN 2 ELSE 1 END AS n_root
  FROM e)
SELECT event_id,
       CAST(len(list_filter(errs, lambda x: x)) AS INTEGER) AS error_count,
       CASE WHEN len(list_filter(errs[1:n_root], lambda x: x)) > 0 THEN '$'
            WHEN len(list_filter(errs, lambda x: x)) > 0 THEN '$.k' END AS first_path,
       CASE WHEN len(list_filter(errs, lambda x: x)) > 0 THEN 'schema_error' END AS failure_code
FROM c
""")
def json_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 with a per-row schema: events joined to a schema per event_type."""
    ev = spread(read_table(spark, sf_dir, "events").select("event_id", "event_type", "props"))
    rows = ev.join(F.broadcast(schema_table(spark)), "event_type").withColumn("doc", F.parse_json("props"))
    checked = check_against_schemas(rows, "doc", "expected_schema")
    return checked.select("event_id", F.col("schema_error_count").alias("error_count"),
                          F.col("schema_first_path").alias("first_path"), F.col("schema_code").alias("failure_code"))


FEATURE_CONTRACT = (("line", "integer"), ("quantity", "float"), ("returned", "boolean"))


def damaged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spread(read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"))
    n = F.col("l_linenumber")
    line = F.when(n == 5, F.concat(n.cast("string"), F.lit(".0"))).otherwise(n.cast("string"))
    qty = F.when(n == 2, F.col("l_quantity").cast("bigint").cast("string")).otherwise(F.col("l_quantity").cast("string"))
    ret = F.when(n == 6, F.lit("1")).otherwise(F.when(F.col("l_returnflag") == "R", "true").otherwise("false"))
    text = F.concat(
        F.lit('{"quantity":'), qty, F.lit(',"line":'), line,
        F.when(n == 4, F.lit("")).otherwise(F.concat(F.lit(',"returned":'), ret)),
        F.when(n == 3, F.lit(',"x":1')).otherwise(F.lit("")), F.lit("}"))
    return li.select("l_orderkey", "l_linenumber", text.alias("features"))


@query("feature_contract", """
WITH f AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag = 'R' AS returned FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CASE l_linenumber
         WHEN 2 THEN 'Feature quantity must have type float'
         WHEN 3 THEN 'Feature keys do not match contract; missing=[], extra=[x]'
         WHEN 4 THEN 'Feature keys do not match contract; missing=[returned], extra=[]'
         WHEN 5 THEN 'Feature line must have type integer'
         WHEN 6 THEN 'Feature returned must have type boolean' END AS problem,
       CASE WHEN l_linenumber IN (1, 7) THEN
         '{"line":' || CAST(l_linenumber AS VARCHAR) || ',"quantity":' || CAST(l_quantity AS VARCHAR)
         || ',"returned":' || CAST(returned AS VARCHAR) || '}' END AS canonical,
       CASE WHEN l_linenumber IN (1, 7) THEN [CAST(l_linenumber AS DOUBLE), l_quantity,
            CASE WHEN returned THEN 1.0 ELSE 0.0 END] END AS vector
FROM f
""")
def feature_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 check, then B7 ordered values and B6 canonical identity of valid rows."""
    d = damaged_features(spark, sf_dir)
    typed = with_feature_problem(d, "features", FEATURE_CONTRACT, "problem")
    ok = F.col("problem").isNull()
    names = [n for n, _ in FEATURE_CONTRACT]
    return typed.select(
        "l_orderkey", "l_linenumber", "problem",
        F.when(ok, canonical_features(names)).alias("canonical"),
        F.when(ok, F.array(*[F.col(n).cast("double") for n in names])).alias("vector"),
    )
