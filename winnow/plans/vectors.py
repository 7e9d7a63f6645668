"""Vector queries over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import embedding_problem
from ..operators.similarity import nearest_neighbours, semantic_dedup_with_evidence, top1_against
from ..session import read_table
from .registry import query

DIM = 64
THRESHOLD = 0.65


@query("nearest_accepted", """
WITH p AS (
  SELECT q.vec_id, r.vec_id AS nid,
         list_cosine_distance(q.embedding::DOUBLE[], r.embedding::DOUBLE[]) AS d
  FROM embeddings q JOIN embeddings r ON q.label = r.label AND r.vec_id < q.vec_id
  QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY d, r.vec_id) = 1)
SELECT e.vec_id, p.nid AS nearest_id, round(p.d, 9) AS distance
FROM embeddings e LEFT JOIN p ON e.vec_id = p.vec_id
""")
def nearest_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + F3: per vector, the nearest earlier vector (all earlier rows
    count as accepted) within the same label; ties by lowest id."""
    emb = read_table(spark, sf_dir, "embeddings")
    near = nearest_neighbours(emb, emb, ["label"], "vec_id", "embedding", order=None, earlier_only=True)
    return emb.select("vec_id").join(near, "vec_id", "left").select(
        "vec_id", "nearest_id", F.round("distance", 9).alias("distance"))


@query("vector_top1", """
WITH q AS (SELECT vec_id, embedding FROM embeddings ORDER BY vec_id DESC LIMIT 1)
SELECT q.vec_id AS query_id, e.vec_id AS nearest_id,
       round(list_cosine_distance(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 9) AS distance
FROM embeddings e, q WHERE e.vec_id <> q.vec_id
ORDER BY list_cosine_distance(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), e.vec_id LIMIT 1
""")
def vector_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored vector nearest to the newest one."""
    emb = read_table(spark, sf_dir, "embeddings")
    q = emb.orderBy(F.col("vec_id").desc()).limit(1)
    return top1_against(emb, q, "vec_id", "embedding").select(
        "query_id", "nearest_id", F.round("distance", 9).alias("distance"))


SEMANTIC_SQL = f"""
WITH RECURSIVE e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, row_number() OVER (ORDER BY vec_id) AS rn FROM embeddings),
nb AS (
  SELECT b.rn, list(a.rn) AS nbs FROM e a JOIN e b
    ON a.rn < b.rn AND list_cosine_distance(a.v, b.v) <= {THRESHOLD}
  GROUP BY b.rn),
g(rn, acc) AS (
  SELECT CAST(1 AS BIGINT), [CAST(1 AS BIGINT)]
  UNION ALL
  SELECT g.rn + 1,
         CASE WHEN list_has_any(g.acc, coalesce(nb.nbs, [])) THEN g.acc ELSE list_append(g.acc, g.rn + 1) END
  FROM g LEFT JOIN nb ON nb.rn = g.rn + 1
  WHERE g.rn < (SELECT max(rn) FROM e)),
fin AS (SELECT acc FROM g ORDER BY rn DESC LIMIT 1),
st AS (SELECT e.vec_id, e.rn, e.v, list_contains((SELECT acc FROM fin), e.rn) AS is_acc FROM e),
near AS (
  SELECT q.vec_id, r.vec_id AS nid, list_cosine_distance(q.v, r.v) AS d
  FROM st q JOIN st r ON r.is_acc AND r.rn < q.rn
  QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY d, r.vec_id) = 1)
SELECT st.vec_id,
       CASE WHEN is_acc THEN 'accepted' ELSE 'rejected' END AS status,
       CASE WHEN is_acc THEN NULL ELSE 'duplicate_sample' END AS failure_code,
       near.nid AS nearest_id, round(near.d, 9) AS distance
FROM st LEFT JOIN near ON st.vec_id = near.vec_id
"""


@query("semantic_dedup", SEMANTIC_SQL)
def semantic_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 + G3: greedy semantic dedup in vec_id order over the whole table
    (one dataset, one embedding model), threshold inclusive."""
    emb = read_table(spark, sf_dir, "embeddings")
    out, _ = semantic_dedup_with_evidence(emb, [], "vec_id", "embedding", THRESHOLD, DIM)
    return out.select("vec_id", "status", "failure_code", "nearest_id", F.round("distance", 9).alias("distance"))


#: Blocks by label, a vector planted again under a new id, a zero vector, and a store of accepted ones.
PLANTED_SQL = f"""
WITH RECURSIVE planted AS (
  SELECT vec_id AS id, label % 3 AS blk, CASE WHEN vec_id % 50 = 3 THEN list_transform(embedding::DOUBLE[], lambda x: 0.0) ELSE embedding::DOUBLE[] END AS v,
         vec_id % 11 = 0 AS store, vec_id % 50 = 3 AS zero FROM embeddings
  UNION ALL
  SELECT vec_id + 1000000, label % 3, embedding::DOUBLE[], false, false FROM embeddings WHERE vec_id % 7 = 0 AND vec_id % 50 <> 3),
c AS (SELECT *, row_number() OVER (ORDER BY id) AS rn FROM planted WHERE NOT store AND NOT zero),
p AS (SELECT * FROM planted WHERE store AND NOT zero),
blocked AS (SELECT DISTINCT c.rn FROM c JOIN p ON c.blk = p.blk AND list_cosine_distance(c.v, p.v) <= {THRESHOLD}),
nb AS (
  SELECT b.rn, list(a.rn) AS nbs FROM c a JOIN c b ON a.blk = b.blk AND a.rn < b.rn AND list_cosine_distance(a.v, b.v) <= {THRESHOLD}
  GROUP BY b.rn),
g(rn, acc) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT g.rn + 1,
         CASE WHEN blocked.rn IS NOT NULL OR list_has_any(g.acc, coalesce(nb.nbs, [])) THEN g.acc ELSE list_append(g.acc, g.rn + 1) END
  FROM g LEFT JOIN nb ON nb.rn = g.rn + 1 LEFT JOIN blocked ON blocked.rn = g.rn + 1
  WHERE g.rn < (SELECT max(rn) FROM c)),
fin AS (SELECT acc FROM g ORDER BY rn DESC LIMIT 1),
ok AS (SELECT c.*, list_contains((SELECT acc FROM fin), c.rn) AS is_acc FROM c),
held AS (SELECT id, blk, v, true AS old FROM p UNION ALL SELECT id, blk, v, false FROM ok WHERE is_acc),
near AS (
  SELECT q.id, r.id AS nid, list_cosine_distance(q.v, r.v) AS d
  FROM ok q JOIN held r ON q.blk = r.blk AND (r.old OR r.id < q.id)
  QUALIFY row_number() OVER (PARTITION BY q.id ORDER BY round(d, 12), r.id) = 1)
SELECT ok.id, CASE WHEN is_acc THEN 'accepted' ELSE 'rejected' END AS status,
       CASE WHEN is_acc THEN NULL ELSE 'duplicate_sample' END AS failure_code, round(near.d, 9) AS distance
FROM ok LEFT JOIN near ON ok.id = near.id
UNION ALL
SELECT id, 'rejected', 'semantic_dedup_error', NULL FROM planted WHERE zero AND NOT store
"""


@query("semantic_dedup_blocks", PLANTED_SQL)
def semantic_dedup_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 + G3 in several blocks, with exact copies, zero vectors and a store of accepted
    vectors, over more than one tile."""
    emb = read_table(spark, sf_dir, "embeddings")
    v = F.col("embedding").cast("array<double>")
    zero = F.col("vec_id") % 50 == 3
    base = emb.select(F.col("vec_id").alias("id"), (F.col("label") % 3).alias("blk"), (F.col("vec_id") % 11 == 0).alias("store"),
                      F.when(zero, F.transform(v, lambda x: F.lit(0.0))).otherwise(v).alias("v"))
    copies = emb.filter((F.col("vec_id") % 7 == 0) & ~zero).select(
        (F.col("vec_id") + 1000000).alias("id"), (F.col("label") % 3).alias("blk"), F.lit(False).alias("store"), v.alias("v"))
    rows = base.unionByName(copies)
    out, _ = semantic_dedup_with_evidence(rows.filter("NOT store").drop("store"), ["blk"], "id", "v", THRESHOLD, DIM,
                                          prior_accepted=rows.filter("store").drop("store"), tile_rows=200)
    # an undefined distance is shown as none
    return out.select("id", "status", "failure_code", F.round(F.nanvl("distance", F.lit(None).cast("double")), 9).alias("distance"))


@query("embedding_check", f"""
WITH d AS (
  SELECT vec_id,
         CASE vec_id % 5 WHEN 1 THEN embedding[1:{DIM - 1}]
                         WHEN 2 THEN list_concat(['NaN'::FLOAT], embedding[2:{DIM}])
                         WHEN 3 THEN list_concat(embedding[1:{DIM - 1}], ['Infinity'::FLOAT])
                         ELSE embedding END AS v
  FROM embeddings)
SELECT vec_id,
       CASE WHEN v IS NULL THEN 'missing'
            WHEN len(v) <> {DIM} THEN 'wrong_dimension'
            WHEN list_bool_or(list_transform(v, lambda x: x IS NULL)) THEN 'null_component'
            WHEN list_bool_or(list_transform(v, lambda x: isnan(x) OR isinf(x))) THEN 'non_finite' END AS problem
FROM d
""")
def embedding_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B11 on embeddings with truncated, NaN and infinite variants."""
    emb = read_table(spark, sf_dir, "embeddings")
    e = F.col("embedding")
    k = F.col("vec_id") % 5
    v = (F.when(k == 1, F.slice(e, 1, DIM - 1))
         .when(k == 2, F.concat(F.array(F.lit(float("nan")).cast("float")), F.slice(e, 2, DIM - 1)))
         .when(k == 3, F.concat(F.slice(e, 1, DIM - 1), F.array(F.lit(float("inf")).cast("float"))))
         .otherwise(e))
    return emb.select("vec_id", embedding_problem(v, DIM).alias("problem"))
