"""Report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.jsonops import structured_json_gate
from ..operators.jsonschema import check_against_schema
from ..operators.ranking import exact_percentiles, select_top
from ..operators.score import LinearRule, latency_histogram, score
from ..session import read_table, spread
from .registry import query
from .selection import select_classification


@query("trial_metrics", """
WITH c AS (@select_classification@)
SELECT d.source AS model, CAST(count(*) AS BIGINT) AS n,
       round(avg(CASE WHEN (d.n_chars >= 1000) = (l.quality = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(CASE WHEN c.status = 'accepted' THEN 1.0 ELSE 0.0 END), 6) AS valid_share,
       quantile_cont(d.n_chars, 0.5) AS latency_p50, quantile_cont(d.n_chars, 0.9) AS latency_p90
FROM labels l JOIN documents d ON l.doc_id = d.doc_id JOIN c ON c.doc_id = l.doc_id
GROUP BY d.source
""")
def trial_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 per model (source): accuracy of a length rule against the quality
    label, share of valid outputs, and the length distribution standing in
    for latency (exact percentiles without a buffer per model)."""
    lab = read_table(spark, sf_dir, "labels")
    doc = read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    cls = select_classification(spark, sf_dir).select("doc_id", "status")
    x = lab.join(doc, "doc_id").join(cls, "doc_id")
    hit = F.when((F.col("n_chars") >= 1000) == (F.col("quality") == 1), 1.0).otherwise(0.0)
    ok = F.when(F.col("status") == codes.ACCEPTED, 1.0).otherwise(0.0)
    x = x.select(F.col("source").alias("model"), hit.alias("hit"), ok.alias("ok"), "n_chars").checkpoint(eager=True)
    shares = x.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("hit"), 6).alias("accuracy"), F.round(F.avg("ok"), 6).alias("valid_share"))
    times = exact_percentiles(x, "model", "n_chars", {"latency_p50": 0.5, "latency_p90": 0.9}).withColumnRenamed("model", "_m")
    return shares.join(times, F.col("model").eqNullSafe(F.col("_m")), "left").drop("_m")


@query("json_stability", """
SELECT e.event_type AS model, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (g.failure_code IS NULL) AS BIGINT) AS stable,
       round(avg(CASE WHEN g.failure_code IS NULL THEN 1.0 ELSE 0.0 END), 6) AS json_stability
FROM (@structured_json_gate@) g JOIN events e ON e.event_id = g.event_id GROUP BY e.event_type
""")
def json_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: per model, the share of its raw outputs that the structured JSON gate lets through."""
    from .jsongate import MAX_CHARS, MAX_DEPTH, damaged_props

    outputs = damaged_props(spark, sf_dir).select("event_id", structured_json_gate(F.col("text"), MAX_CHARS, MAX_DEPTH).isNull().cast("int").alias("ok"))
    e = read_table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("model"))
    return outputs.join(e, "event_id").groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ok").alias("stable"), F.round(F.avg(F.col("ok").cast("double")), 6).alias("json_stability"))


@query("compare_generations", """
WITH m AS (@trial_metrics@),
g AS (SELECT model, CAST(substring(model, 4) AS INTEGER) AS generation, accuracy FROM m)
SELECT model, generation, accuracy,
       lag(accuracy) OVER (ORDER BY generation) AS prev_accuracy,
       round(accuracy - lag(accuracy) OVER (ORDER BY generation), 6) AS delta
FROM g
""")
def compare_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: each model generation against the previous one.  The window runs
    over the per-model metrics (one row per model), not over the data."""
    m = trial_metrics(spark, sf_dir).select("model", F.expr("substring(model, 4)").cast("int").alias("generation"), "accuracy")
    w = Window.partitionBy(F.lit(0)).orderBy("generation")
    prev = F.lag("accuracy").over(w)
    return m.select("model", "generation", "accuracy", prev.alias("prev_accuracy"),
                    F.round(F.col("accuracy") - prev, 6).alias("delta"))


@query("passport_gaps", """
SELECT c_custkey AS model_id, f.field
FROM customer, (VALUES ('c_name'), ('c_mktsegment'), ('c_acctbal')) f(field)
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
  AND ((f.field = 'c_name' AND (c_name IS NULL OR trim(c_name) = ''))
    OR (f.field = 'c_mktsegment' AND c_mktsegment IS NULL)
    OR (f.field = 'c_acctbal' AND (c_acctbal IS NULL OR c_acctbal < 0)))
""")
def passport_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers standing in for models in a working status (segment
    BUILDING or MACHINERY) with a required passport field missing or
    invalid; one row per (model, field)."""
    c = read_table(spark, sf_dir, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    checks = F.array(
        F.when(F.col("c_name").isNull() | (F.trim("c_name") == ""), F.lit("c_name")),
        F.when(F.col("c_mktsegment").isNull(), F.lit("c_mktsegment")),
        F.when(F.col("c_acctbal").isNull() | (F.col("c_acctbal") < 0), F.lit("c_acctbal")))
    return c.select(F.col("c_custkey").alias("model_id"), F.explode(F.filter(checks, lambda x: x.isNotNull())).alias("field"))


@query("generation_report", """
WITH s AS (
  SELECT e.event_type AS model, CAST(month(e.ts) AS INTEGER) AS generation, r.status, r.failure_code
  FROM events e JOIN (@select_regression_events@) r ON e.event_id = r.event_id)
SELECT model, generation, CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE status = 'accepted') AS BIGINT) AS accepted,
       CAST(count(*) FILTER (WHERE status = 'rejected') AS BIGINT) AS rejected,
       CAST(count(*) FILTER (WHERE failure_code = 'range_error') AS BIGINT) AS range_errors,
       CAST(count(*) FILTER (WHERE failure_code = 'duplicate_sample') AS BIGINT) AS duplicates,
       round(avg(CASE WHEN status = 'accepted' THEN 1.0 ELSE 0.0 END), 6) AS pass_rate
FROM s GROUP BY model, generation
""")
def generation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: counters, pass rate and rejection mix per model and generation."""
    from .selection import regression_selection

    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    s = regression_selection(spark, sf_dir).join(ev, "event_id")
    return s.groupBy(F.col("event_type").alias("model"), F.month("ts").cast("int").alias("generation")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == codes.ACCEPTED).alias("accepted"),
        F.count_if(F.col("status") == codes.REJECTED).alias("rejected"),
        F.count_if(F.col("failure_code") == codes.RANGE_ERROR).alias("range_errors"),
        F.count_if(F.col("failure_code") == codes.DUPLICATE_SAMPLE).alias("duplicates"),
        F.round(F.avg(F.when(F.col("status") == codes.ACCEPTED, 1.0).otherwise(0.0)), 6).alias("pass_rate"))


HYBRID_SCHEMA = {"type": "object", "required": ["score", "user"], "additionalProperties": False,
                 "properties": {"score": {"type": "number", "minimum": 0, "maximum": 500},
                                "user": {"type": "integer", "minimum": 0}}}


@query("hybrid_selection", """
WITH s AS (
  SELECT event_id, user_id, CAST(value * 2 - 100 AS DECIMAL(12,2)) AS score FROM events),
t AS (
  SELECT event_id, score, user_id,
         '{"score":' || CAST(score AS VARCHAR) || ',"user":' || CAST(user_id AS VARCHAR) || '}' AS completion FROM s)
SELECT event_id, completion,
       CASE WHEN length(completion) > 64 THEN 'too_long_output'
            WHEN score < 0 OR score > 500 THEN 'schema_error' END AS failure_code,
       CASE WHEN score < 0 OR score > 500 THEN '$.score' END AS first_path
FROM t
""")
def hybrid_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: a model score decides (linear rule on value), a JSON text is
    attached, and the structured-JSON gate and schema check judge the row."""
    ev = spread(read_table(spark, sf_dir, "events").select("event_id", "user_id", "value"))
    sc = (F.col("value") * 2 - 100).cast("decimal(12,2)")
    t = ev.select("event_id", F.concat(F.lit('{"score":'), sc.cast("string"), F.lit(',"user":'),
                                       F.col("user_id").cast("string"), F.lit("}")).alias("completion"))
    g = t.withColumn("gate", structured_json_gate(F.col("completion"), 64, 3))
    checked = check_against_schema(g.withColumn("doc", F.try_parse_json("completion")), "doc", HYBRID_SCHEMA)
    return checked.select("event_id", "completion", F.coalesce("gate", "schema_code").alias("failure_code"),
                          F.when(F.col("gate").isNull(), F.col("schema_first_path")).alias("first_path"))


@query("lineage_closure", """
WITH RECURSIVE a(model_id, ancestor, depth) AS (
  SELECT s_suppkey, s_suppkey // 2, 1 FROM supplier WHERE s_suppkey > 0
  UNION ALL
  SELECT a.model_id, a.ancestor // 2, a.depth + 1 FROM a WHERE a.ancestor > 0)
SELECT model_id, ancestor, CAST(depth AS INTEGER) AS depth FROM a
""")
def lineage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: every ancestor of every model through parent_model_id
    (parent = key // 2 over supplier; 0 is the root), by path doubling."""
    from ..operators.lineage import ancestors

    s = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("model_id"))
    edges = s.select("model_id", F.when(F.col("model_id") > 0, F.floor(F.col("model_id") / 2)).cast("bigint").alias("parent_id"))
    # parents are keys too, even when not present as rows (the root 0 is)
    return ancestors(edges, "model_id", "parent_id")


def _words(text_col):
    """Lower-cased words of a text (letters and digits, any script)."""
    return F.filter(F.split(F.regexp_replace(F.lower(text_col), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def _shingles(words, n: int = 8):
    """n-word shingles of a word-array *column* (bound first: a lambda over
    an inline expression would re-split the whole text for every shingle)."""
    grams = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.array_join(F.slice(words, i + 1, n), " "))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))


@query("eval_separation", """
WITH dw AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(lower(text), '[^\\pL\\pN]+', ' ', 'g'), ' '), lambda w: w <> '') AS w
  FROM documents),
bw AS (
  SELECT item_id, list_filter(string_split(regexp_replace(lower(text), '[^\\pL\\pN]+', ' ', 'g'), ' '), lambda w: w <> '') AS w
  FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 8], ' ') AS sh FROM dw, range(0, len(w) - 7) t(i) WHERE len(w) >= 8),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i + 1:i + 8], ' ') AS sh FROM bw, range(0, len(w) - 7) t(i) WHERE len(w) >= 8)
SELECT ds.doc_id, CAST(count(DISTINCT ds.sh) AS BIGINT) AS shared_shingles, CAST(count(DISTINCT bs.item_id) AS BIGINT) AS items
FROM ds JOIN bs ON ds.sh = bs.sh GROUP BY ds.doc_id
""")
def eval_separation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: documents sharing normalised 8-word shingles with benchmark items
    (whole texts).  A shingle travels as two 64-bit hashes and never as text;
    only shingles that some benchmark item has survive the semi join; distinct
    counts are counts of pre-aggregated groups, without an expand."""
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    b = read_table(spark, sf_dir, "benchmark").select("item_id", "text")

    def hashed(df: DataFrame, key: str) -> DataFrame:
        grams = df.select(key, _words(F.col("text")).alias("w")).select(key, F.explode(_shingles(F.col("w"))).alias("sh"))
        return grams.select(key, F.xxhash64("sh").alias("h1"), F.xxhash64(F.lit(1), "sh").alias("h2"))

    items = hashed(b, "item_id").distinct().checkpoint(eager=True)
    hits = hashed(d, "doc_id").join(items.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").distinct().checkpoint(eager=True)
    shared = hits.groupBy("doc_id").agg(F.count(F.lit(1)).alias("shared_shingles"))
    of_items = hits.join(items, ["h1", "h2"]).select("doc_id", "item_id").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("items"))
    return shared.join(of_items, "doc_id").select("doc_id", "shared_shingles", "items")


@query("eval_exact_overlap", """
WITH d AS (
  SELECT doc_id, text FROM documents
  UNION ALL SELECT 1000000000 + item_id, '  ' || text || ' ' FROM benchmark WHERE item_id % 3 = 0)
SELECT d.doc_id, CAST(count(DISTINCT b.item_id) AS BIGINT) AS items
FROM d JOIN benchmark b ON md5(lower(trim(d.text))) = md5(lower(trim(b.text))) GROUP BY d.doc_id
""")
def eval_exact_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: documents whose whole text is a benchmark item's, by digest.  Copies of every third
    item are planted under ids of their own."""
    digest = F.md5(F.lower(F.trim("text")))
    items = read_table(spark, sf_dir, "benchmark")
    planted = items.filter(F.col("item_id") % 3 == 0).select((F.col("item_id") + 1000000000).alias("doc_id"), F.concat(F.lit("  "), "text", F.lit(" ")).alias("text"))
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(planted).select("doc_id", digest.alias("digest"))
    b = items.select("item_id", digest.alias("digest")).distinct()
    return d.join(b, "digest").select("doc_id", "item_id").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("items"))


@query("training_documents", """
WITH hit AS (@eval_separation@)
SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM hit WHERE shared_shingles >= 1)
""")
def training_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5, the filter: documents without a shingle of the benchmark."""
    hit = eval_separation(spark, sf_dir).select("doc_id")
    return read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(hit, "doc_id", "left_anti")


@query("dataset_card", """
WITH ok AS (SELECT d.* FROM documents d JOIN (@source_rules@) r ON d.doc_id = r.doc_id WHERE r.problem IS NULL)
SELECT lang, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars,
       CAST(count(DISTINCT text) AS BIGINT) AS n_distinct_texts, CAST(count(DISTINCT source) AS BIGINT) AS n_sources,
       min(doc_id) AS first_doc, max(doc_id) AS last_doc,
       CAST(sum(CAST(('0x' || substr(md5(text), 1, 15)) AS BIGINT)) AS VARCHAR) AS checksum
FROM ok GROUP BY lang
""")
def dataset_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: card of the accepted documents (those passing the source rules), with
    an order-independent checksum.  Length and digest are taken in the scan;
    no text is shuffled; distinct counts are counts of pre-aggregated groups."""
    from .text import source_rules

    ok = source_rules(spark, sf_dir).filter(F.col("problem").isNull()).select("doc_id")
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.length("text").alias("chars"), F.md5("text").alias("digest"))
    by = d.join(ok, "doc_id").groupBy("lang", "source", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    by = by.checkpoint(eager=True)
    texts = by.groupBy("lang", "digest").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("n_distinct_texts"))
    sources = by.groupBy("lang", "source").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count("source").alias("n_sources"))
    # the join keeps each document once, so a group's checksum is its digest times its rows
    total = F.sum(F.conv(F.substring("digest", 1, 15), 16, 10).cast("decimal(38,0)") * F.col("n")).cast("decimal(38,0)").cast("string")
    card = by.groupBy("lang").agg(F.sum("n").alias("n_docs"), F.sum("chars").cast("bigint").alias("n_chars"),
                                  F.min("low").alias("first_doc"), F.max("high").alias("last_doc"), total.alias("checksum"))
    return card.join(texts, "lang").join(sources, "lang").select(
        "lang", "n_docs", "n_chars", "n_distinct_texts", "n_sources", "first_doc", "last_doc", "checksum")


@query("score_batch", """
SELECT l_orderkey, l_linenumber, l_partkey, 'regression' AS mode,
       l_quantity * 100.0 + CAST(l_linenumber AS DOUBLE) * 10.0 + CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS prediction
FROM lineitem
""")
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplied model (100*first + 10*second + flag) scores every
    lineitem in Arrow batches; the model is built once per partition."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.col("l_linenumber").cast("double").alias("f_line"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("f_flag"))
    s = score(li, ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "f_line", "f_flag"],
              lambda: LinearRule([100.0, 10.0, 1.0]), "regression", "linear_rule_v1")
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "mode", "prediction")


_TOP_SQL = """
WITH e AS (SELECT event_id, event_type, CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'NaN'::DOUBLE ELSE round(value) END AS score FROM events),
r AS (
  SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY score DESC, event_id) AS r, count(*) OVER (PARTITION BY event_type) AS n
  FROM e WHERE score IS NOT NULL AND NOT isnan(score))
SELECT e.event_id, e.event_type, coalesce(r.r <= {wanted}, false) AS selected FROM e LEFT JOIN r ON e.event_id = r.event_id
"""


def _scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-number scores (so that many tie), some missing, some not a number."""
    k = F.col("event_id")
    score = F.when(k % 17 == 0, F.lit(None).cast("double")).when(k % 19 == 0, F.lit(float("nan"))).otherwise(F.round("value"))
    return read_table(spark, sf_dir, "events").select("event_id", "event_type", score.alias("score"))


@query("top_share", _TOP_SQL.replace("{wanted}", "ceil(round(0.15 * n, 6))"))
def top_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the best 15 % of each event type by score, ties by id."""
    return select_top(_scored_events(spark, sf_dir), "event_type", "score", "event_id", share=0.15).select("event_id", "event_type", "selected")


@query("top_n", _TOP_SQL.replace("{wanted}", "100"))
def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the best 100 rows of each event type by score, ties by id."""
    return select_top(_scored_events(spark, sf_dir), "event_type", "score", "event_id", n=100).select("event_id", "event_type", "selected")


@query("score_latency", """
SELECT 'linear_rule_v1' AS pipeline_id, CAST(count(*) AS BIGINT) AS n, true AS all_measured, true AS totals_agree FROM lineitem
""")
def score_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every output has a latency; the histogram's total is the sum over all outputs.  The
    milliseconds differ from run to run, so only what holds for each of them is returned."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", F.col("l_linenumber").cast("double").alias("f_line"))
    s = score(li, ["l_orderkey"], ["l_quantity", "f_line"], lambda: LinearRule([100.0, 10.0]), "regression", "linear_rule_v1", latency=True)
    s = s.checkpoint(eager=True)  # the times of one run, read twice
    rows = s.groupBy("pipeline_id").agg(F.count(F.lit(1)).alias("n"), F.every(F.col("latency_ms") >= 0).alias("all_measured"), F.sum("latency_ms").alias("total"))
    whole = latency_histogram(s, ["pipeline_id"]).groupBy("pipeline_id").agg(F.sum("n").alias("hn"), F.sum("total_ms").alias("htotal"))
    agree = (F.col("n") == F.col("hn")) & (F.abs(F.col("total") - F.col("htotal")) <= 1e-9 * F.col("total"))
    return rows.join(whole, "pipeline_id").select("pipeline_id", "n", "all_measured", agree.alias("totals_agree"))
