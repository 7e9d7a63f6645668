"""The registered queries ``opN_<name>`` over the given tables and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table
from . import ann, bpe, cws, hard_negatives, html_extract, licenses, line_dedup, merkle, mixing, quality, sharding, simhash, subword_lm

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


#: Shards of op1 and the grown number.
SHARDS, GROWN = 40, 41


@query
def op1_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = sharding.shard_records(docs, ["doc_id"], [1.0] * SHARDS, [1.0] * GROWN)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def _license_sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def canonical(col: str) -> str:
        t = f"regexp_replace(lower(coalesce({col}, '')), '{licenses.COPYRIGHT_LINE.replace('(?dm)', '(?m)')}', '', 'g')"
        t = f"regexp_replace(' ' || {t} || ' ', '{licenses.NOT_WORD}', '  ', 'g')"
        t = f"replace({t}, chr(10), '  ' || chr(10) || '  ')"
        for a, b in licenses.EQUIVALENT:
            t = f"replace({t}, ' {a.replace(' ', '  ')} ', ' {b.replace(' ', '  ')} ')"
        return t

    tidy = lambda c: f"trim(regexp_replace({c}, ' +', ' ', 'g'))"
    known = ", ".join(f"({quote(i)}, {quote(t)})" for i, t in licenses.KNOWN)
    return f"""
WITH known AS (
  SELECT sha256({tidy("replace(" + canonical("text") + ", chr(10), ' ')")}) AS digest, min(license_id) AS license_id
  FROM (VALUES {known}) AS k(license_id, text) GROUP BY 1),
rows AS (SELECT doc_id, row_number() OVER () AS r, {canonical("text")} AS body FROM documents),
lines AS (
  SELECT r, {tidy("x")} AS line FROM (SELECT r, unnest(string_split(body, chr(10))) AS x FROM rows)),
hits AS (
  SELECT r, count(*) AS n, array_to_string(list_sort(list_distinct(list(license_id))), ',') AS ids
  FROM lines JOIN known ON sha256(line) = digest WHERE line <> '' GROUP BY r),
whole AS (SELECT doc_id, r, sha256({tidy("replace(body, chr(10), ' ')")}) AS text_digest FROM rows)
SELECT w.doc_id, w.text_digest, k.license_id, coalesce(h.n, 0)::BIGINT AS n_license_lines, coalesce(h.ids, '') AS line_licenses
FROM whole w LEFT JOIN known k ON w.text_digest = k.digest LEFT JOIN hits h ON w.r = h.r
"""


ORACLES["op6_license_scan"] = _license_sql()


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = mixing.sample_copies(read_table(spark, sf_dir, "documents"))
    return copies.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


#: (rank of each document within its source, targets, copies) as SQL over a view ``docs``.
MIX_SQL = r"""
sized AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM {docs}),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, 3 * source_size AS cap,
         [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT] AS w FROM sources),
ordered AS (
  SELECT *, row_number() OVER o AS pos,
         sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_size,
         sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_w
  FROM weighted WINDOW o AS (ORDER BY cap::DOUBLE / w::DOUBLE, source NULLS LAST)),
level AS (SELECT left_size::DOUBLE / left_w::DOUBLE AS level FROM ordered
          WHERE cap::DOUBLE > w * (left_size::DOUBLE / left_w::DOUBLE) ORDER BY pos LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN level IS NULL OR cap::DOUBLE <= w * level THEN cap::DOUBLE ELSE w * level END AS target,
         ('0x' || substr(md5('systematic|7|' || coalesce(source, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM ordered LEFT JOIN level ON true),
ranked AS (
  SELECT s.*, t.source_size, t.target, t.u,
         CASE WHEN t.source_size = 0 THEN 1.0::DOUBLE ELSE t.target / t.source_size::DOUBLE END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) - 1 AS r
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT *, (floor((r + 1)::DOUBLE * rate + u) - floor(r::DOUBLE * rate + u))::BIGINT AS copies FROM ranked)
"""
ORACLES["op7_mix_sources"] = "WITH " + MIX_SQL.replace("{docs}", "documents") + """
SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed
"""


@query
def op2_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"), any_bits=True)
    return out.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"),
                      F.sha2("text", 256).alias("text_sha256"), "text")


@query
def op4_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").filter(~quality.held_out(F.col("doc_id")))
    out = quality.classify(docs, quality.fit(docs, labels))
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
                      F.col("__predicted").alias("predicted"))


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoded_digests(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the real ids and texts."""
    spec = bpe.read_spec(spark, tokenizer or byte_bpe_path())
    coded = bpe.encode_documents(docs.select("doc_id", "text"), spec, decoded=True)
    joined = F.array_join(F.col("__ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("__ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"),
                        F.sha2("__decoded", 256).alias("decoded_sha256"))


@query
def op8_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(spark, read_table(spark, sf_dir, "documents"))


@query
def op5_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.fingerprint_edits(read_table(spark, sf_dir, "documents"))


@query
def op10_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op9_host_suffix_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract_main_text(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fields = lambda n: merkle.leaf_digest(*map(F.col, ("doc_id", "source", "lang")), n, F.col("text"))
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    leaves = docs.select("doc_id", "lang", fields(F.col("n_chars")).alias("leaf"),
                         F.when(tampered, fields(F.col("n_chars") + 1)).alias("changed"))
    proven = merkle.inclusion_proofs(leaves, "lang", [F.col("doc_id")])
    out = proven.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                        merkle.fold(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLES["op12_merkle_manifest"] = """
WITH RECURSIVE
crc_steps AS (
  SELECT list(v ORDER BY i) AS steps FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM range(256) AS b(i))),
flagged AS (
  SELECT d.*, doc_id IS NOT NULL AND xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1]))) % 7 = 0 AS tampered
  FROM documents d, crc_steps),
digests AS (
  SELECT doc_id, coalesce('+' || lang, '') AS tree,
         sha256(a || n || b) AS leaf, sha256(a || CASE WHEN tampered THEN n1 ELSE n END || b) AS seen
  FROM (
    SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
              || coalesce(strlen(lang) || ':' || lang, '-') AS a,
           coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n,
           coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS n1,
           coalesce(strlen(text) || ':' || text, '-') AS b
    FROM flagged)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY tree) AS n
  FROM digests),
nodes AS (
  SELECT tree, 0 AS h, r AS i, leaf AS d, n FROM ranked
  UNION ALL
  SELECT tree, h + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY tree, h, i // 2, n),
subroots AS (
  SELECT tree, d AS subroot, h AS height, row_number() OVER (ORDER BY tree) - 1 AS r, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS h, r AS i, subroot AS d, n FROM subroots
  UNION ALL
  SELECT h + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY h, i // 2, n),
tree_paths AS (
  SELECT s.tree, s.subroot, s.height, (SELECT d FROM tops WHERE n = 1) AS root,
         coalesce(list(CASE WHEN t.d IS NULL THEN '' WHEN (s.r >> l.h) % 2 = 1 THEN 'L' || t.d ELSE 'R' || t.d END ORDER BY l.h)
                  FILTER (l.h IS NOT NULL), []) AS path
  FROM subroots s LEFT JOIN (SELECT DISTINCT h FROM tops WHERE n > 1) l ON true
  LEFT JOIN tops t ON t.h = l.h AND t.i = xor(s.r >> l.h, 1) GROUP BY ALL),
leaf_paths AS (
  SELECT k.doc_id, k.tree, k.r, k.leaf, k.seen,
         coalesce(list(CASE WHEN o.d IS NULL THEN '' WHEN (k.r >> l.h) % 2 = 1 THEN 'L' || o.d ELSE 'R' || o.d END ORDER BY l.h)
                  FILTER (l.h IS NOT NULL), []) AS path
  FROM ranked k LEFT JOIN (SELECT DISTINCT tree, h FROM nodes WHERE n > 1) l ON k.tree = l.tree
  LEFT JOIN nodes o ON o.tree = k.tree AND o.h = l.h AND o.i = xor(k.r >> l.h, 1) GROUP BY ALL),
whole AS (
  SELECT l.doc_id, l.leaf, l.seen, t.subroot, t.root, list_concat(l.path, t.path) AS path FROM leaf_paths l JOIN tree_paths t USING (tree)),
folded AS (
  SELECT *, list_reduce(list_concat([seen], path), lambda a, p: sha256(
    CASE WHEN p[1] = 'L' THEN substr(p, 2) || a ELSE a || substr(p, 2) END)) AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda p: substr(p, 2)), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op13_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = subword_lm.score_texts(docs, ~subword_lm.held_out(F.col("doc_id")), subword_lm.read_vocabulary(piece_path()))
    return out.select("doc_id", subword_lm.held_out(F.col("doc_id")).alias("held_out"), F.col("__n_tokens").alias("n_tokens"),
                      F.col("__n_known").alias("n_known"), F.col("__train_tokens").alias("train_tokens"),
                      F.col("__base_score").alias("base_score"), F.col("__score").alias("score"))
