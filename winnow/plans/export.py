"""Export and store queries on the star schema (A3, A4, A7, A9, C8, D3, D6,
D7, D8, E3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..sources.export import json_line
from ..sources.store import first_per_key, new_rows
from ..session import partitions_for, read_table, spread
from .registry import query


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem -> orders -> customer -> nation -> region, plus part.

    nation and region have a fixed size (25 and 5 rows) and are broadcast;
    lineitem-orders, -customer and -part are key joins left to the planner
    (sort-merge at scale, AQE broadcast when a side turns out small)."""
    li = spread(read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                             "l_extendedprice", "l_discount", "l_returnflag"))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    x = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(c, o.o_custkey == c.c_custkey)
         .join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey)
         .join(p, li.l_partkey == p.p_partkey))
    sample_id = F.concat_ws("-", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"),
                            F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
                            F.lpad(F.col("l_partkey").cast("string"), 10, "0"),
                            F.lpad(F.col("l_suppkey").cast("string"), 10, "0"))
    rejected = F.col("l_returnflag") == "R"
    return x.select(
        sample_id.alias("sample_id"),
        F.col("r_name").alias("dataset_id"), F.col("n_name").alias("nation"), F.col("c_name").alias("customer"),
        F.col("p_name").alias("part"), F.col("o_orderstatus").alias("run_status"),
        F.when(rejected, F.lit(codes.REJECTED)).otherwise(F.lit(codes.ACCEPTED)).alias("status"),
        F.when(rejected, F.lit(codes.RANGE_ERROR)).alias("failure_code"),
        F.col("l_extendedprice").alias("score"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
    )


EXPORT_SQL = """
SELECT lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || '-'
         || lpad(CAST(l_partkey AS VARCHAR), 10, '0') || '-' || lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS sample_id,
       r_name AS dataset_id, n_name AS nation, c_name AS customer, p_name AS part, o_orderstatus AS run_status,
       CASE WHEN l_returnflag = 'R' THEN 'rejected' ELSE 'accepted' END AS status,
       CASE WHEN l_returnflag = 'R' THEN 'range_error' END AS failure_code,
       l_extendedprice AS score, CAST(round(l_discount * 100) AS INTEGER) AS discount_pct
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
     JOIN part ON l_partkey = p_partkey"""


@query("export_join", EXPORT_SQL)
def export_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_rows(spark, sf_dir)


@query("export_records", f"""
SELECT sample_id, status,
       json_object('customer', customer, 'dataset_id', dataset_id, 'discount_pct', discount_pct,
                   'failure_code', failure_code, 'nation', nation, 'part', part, 'run_status', run_status,
                   'sample_id', sample_id, 'score', score, 'status', status)::VARCHAR AS line
FROM ({EXPORT_SQL})
""")
def export_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key-sorted JSON record per sample, nulls kept."""
    x = export_rows(spark, sf_dir)
    cols = {c: F.col(c) for c in x.columns}
    return x.select("sample_id", "status", json_line(cols).alias("line"))


@query("export_summary", f"""
SELECT dataset_id, CAST(count(*) FILTER (WHERE status = 'accepted') AS BIGINT) AS accepted,
       CAST(count(*) FILTER (WHERE status = 'rejected') AS BIGINT) AS rejected
FROM ({EXPORT_SQL}) GROUP BY dataset_id
""")
def export_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """accepted/rejected per dataset."""
    from ..operators.reports import export_summary as summary

    return summary(export_rows(spark, sf_dir), ["dataset_id"])


@query("export_violations", f"""
WITH x AS (
  SELECT sample_id, status, failure_code, discount_pct <= 8 AS is_valid FROM ({EXPORT_SQL}))
SELECT sample_id,
       CASE WHEN (status = 'accepted') <> is_valid THEN 'validity_mismatch'
            WHEN status = 'accepted' AND failure_code IS NOT NULL THEN 'accepted_with_failure'
            WHEN status <> 'accepted' AND failure_code IS NULL THEN 'rejected_without_code' END AS violation
FROM x
WHERE (status = 'accepted') <> is_valid OR (status = 'accepted' AND failure_code IS NOT NULL)
   OR (status <> 'accepted' AND failure_code IS NULL)
""")
def export_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 on the export rows, with validity from a separate rule (discount
    within 8%): every row whose verdict and validity disagree."""
    from ..sources.export import consistency_violations

    x = export_rows(spark, sf_dir).withColumn("model_type", F.lit("ml")) \
        .withColumn("is_valid", F.col("discount_pct") <= 8)
    return consistency_violations(x, "ml").select("sample_id", "violation")


@query("provenance_chain", """
SELECT r_name AS region, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_orders, CAST(count(DISTINCT c_custkey) AS BIGINT) AS n_customers,
       CAST(count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS BIGINT) AS n_distinct_lines
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
     JOIN orders ON o_custkey = c_custkey
     JOIN lineitem ON l_orderkey = o_orderkey
     JOIN supplier ON l_suppkey = s_suppkey
GROUP BY r_name
""")
def provenance_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full chain region -> nation -> customer -> order -> line ->
    supplier; each line reached once (composite line key).

    Lines are dealt by order into as many partitions as their number asks for and counted there, with
    each supplier's rows as a weight; only one row per order goes on to customers and regions."""
    r = read_table(spark, sf_dir, "region")
    n = read_table(spark, sf_dir, "nation")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    s = read_table(spark, sf_dir, "supplier").groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("_s"))
    parts = partitions_for(li)
    geo = F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name"))
    # counted up level by level, so that no distinct count multiplies the lines
    lines = li.repartition(parts, "l_orderkey").groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    lines = lines.join(s, lines.l_suppkey == s.s_suppkey).select("l_orderkey", (F.col("n") * F.col("_s")).alias("n"))
    per_order = lines.groupBy("l_orderkey").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"))
    orders = o.repartition(parts, "o_orderkey").groupBy("o_orderkey", "o_custkey").agg(F.count(F.lit(1)).alias("_o"))
    per_customer = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(
        F.sum(F.col("n") * F.col("_o")).alias("n"), F.sum("d").alias("d"), F.count(F.lit(1)).alias("o"))
    owners = c.join(geo, c.c_nationkey == geo.n_nationkey).groupBy("c_custkey", "r_name").agg(F.count(F.lit(1)).alias("_c"))
    return per_customer.join(owners, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("r_name").alias("region")).agg(
        F.sum(F.col("n") * F.col("_c")).alias("n_lines"), F.sum("o").alias("n_orders"), F.count(F.lit(1)).alias("n_customers"), F.sum("d").alias("n_distinct_lines"))


@query("left_count", """
SELECT c_mktsegment AS segment, CAST(count(DISTINCT c_custkey) AS BIGINT) AS n_customers,
       CAST(count(o_orderkey) AS BIGINT) AS n_orders,
       CAST(count(DISTINCT c_custkey) FILTER (WHERE o_orderkey IS NULL) AS BIGINT) AS n_without_orders
FROM customer LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY c_mktsegment
""")
def left_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outer join and a null-skipping count; customers without orders.

    Orders are first reduced to a count per customer (partial aggregate),
    so the outer join is one row per customer on both sides."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    per = read_table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("_n"))
    x = c.join(per, c.c_custkey == per.o_custkey, "left")
    return x.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("n_customers"), F.sum(F.coalesce("_n", F.lit(0))).cast("bigint").alias("n_orders"),
        F.count_if(F.col("_n").isNull()).alias("n_without_orders"))


CUTOFF = "2024-01-16 00:00:00"


@query("append_once", f"""
WITH firsts AS (
  SELECT event_type AS run_id, CAST(user_id AS VARCHAR) AS source_id, event_id, ts FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) = 1),
existing AS (
  SELECT event_type AS run_id, CAST(user_id AS VARCHAR) AS source_id, event_id FROM events
  WHERE ts < TIMESTAMP '{CUTOFF}'
  QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) = 1)
SELECT run_id, source_id, event_id, 'existing' AS origin FROM existing
UNION ALL
SELECT f.run_id, f.source_id, f.event_id, 'appended' AS origin FROM firsts f
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.run_id = f.run_id AND e.source_id = f.source_id)
""")
def append_once_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks imported before the cutoff are the store; then every
    event is replayed.  One task per (run, source); the stored row wins,
    within the batch the earliest event wins."""
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run_id"), F.col("user_id").cast("string").alias("source_id"), "event_id", "ts")
    order = [F.col("ts"), F.col("event_id")]
    existing = first_per_key(ev.filter(F.col("ts") < F.lit(CUTOFF).cast("timestamp")), ["run_id", "source_id"], order)
    batch = first_per_key(ev, ["run_id", "source_id"], order)
    fresh = new_rows(batch, existing, ["run_id", "source_id"])
    return existing.select("run_id", "source_id", "event_id", F.lit("existing").alias("origin")).unionByName(
        fresh.select("run_id", "source_id", "event_id", F.lit("appended").alias("origin")))
