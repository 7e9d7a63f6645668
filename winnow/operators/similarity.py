"""Exact cosine similarity joins on tiles.

Spark has no vector index, and the reference's rules are exact: a
candidate is a duplicate iff its nearest *accepted* embedding is within
the threshold, in queue order.  Pairs are therefore compared exactly:

* rows of one block (dataset, embedding model) are hashed into
  ``ceil(n / tile_rows)`` tiles; each row is sent to every tile pair that
  contains its tile, so a block of any size (even one holding a third of
  all rows) is spread over many bounded tasks;
* one ``applyInPandas`` task per tile pair normalises both tiles and does
  one matrix product; it emits the best neighbour per row, or the pairs
  within the threshold;
* queue order is compared inside each task on the full (order, id) key, so
  no global ranking window is needed and a row never meets itself;
* queries and references are tiled apart, so that many queries against few
  references (all rows against the accepted ones) cost their product only.

Greedy dedup goes over distinct vectors in heads of the queue: near pairs are
made inside a head only, and what its accepted rows cover leaves the queue at
once.  No pair of two rejected rows of different heads is ever made.  The tile
and head sizes decide how the work is cut, never what comes out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.vectors import embedding_ok
from ..session import ensure_checkpoint_dir

DEFAULT_TILE_ROWS = 2048
#: A tile of queries or references that are tiled apart: so many tiles' rows, at most so many rows; its products are made by strips.
CROSS_TILES, CROSS_ROWS, STRIP_ROWS = 16, 8192, 512
#: Rows of the queue whose pairs are made at once; doubled, to at most so many times, while there are fewer pairs per row than this.
HEAD_ROWS, HEAD_GROWTH, FEW_PAIRS = 8192, 4, 4
_NAN_SLOT = np.finfo(np.float64).max


def _tile(df: DataFrame, block: Sequence[str], id_col: str, tile_rows: int) -> DataFrame:
    """Adds ``_tile`` and ``_ntiles``: hash tiles, sized by the block's row count."""
    ntiles = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(tile_rows))).cast("int")
    if not block:
        # one block: its size is a single number (an action returning a scalar)
        out = df.withColumn("_ntiles", ntiles(F.lit(df.count())))
    else:
        counts = df.groupBy(*block).agg(ntiles(F.count(F.lit(1))).alias("_ntiles"))
        # one row per block; AQE broadcasts it when small, else a plain key join
        out = df.join(counts, list(block), "inner")
    return out.withColumn("_tile", F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.col("_ntiles")).cast("int"))


def _to_pairs(df: DataFrame) -> DataFrame:
    """Each row goes to every tile pair (a <= b) that contains its tile."""
    other = F.explode(F.sequence(F.lit(0), F.col("_ntiles") - 1)).alias("_other")
    x = df.select("*", other)
    return x.withColumn("_pa", F.least("_tile", "_other")).withColumn("_pb", F.greatest("_tile", "_other")).drop("_other")


def _local_rank(pdf: pd.DataFrame, order_cols: Sequence[str], ascending: Sequence[bool]) -> np.ndarray:
    """Queue position of each row among the rows of this task; prior
    accepted rows come before every candidate."""
    if not len(pdf):
        return np.zeros(0, dtype=np.int64)
    keys = pdf[list(order_cols)].sort_values(list(order_cols), ascending=list(ascending), kind="mergesort")
    before = keys.shift()
    new = ~((keys == before) | (keys.isna() & before.isna())).all(axis=1)
    rank = np.empty(len(pdf), dtype=np.int64)
    # equal keys (the query and the reference copy of one row) share a position
    rank[pdf.index.get_indexer(keys.index)] = new.cumsum().to_numpy()
    rank[pdf["_prior"].to_numpy(dtype=bool)] = -1
    return rank


def _unit(vectors) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 0))
    n = np.linalg.norm(m, axis=1, keepdims=True) if len(m) else np.zeros((0, 1))
    with np.errstate(invalid="ignore", divide="ignore"):
        return m / n


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine distances; the similarity is clipped to [-1, 1], so equal vectors are at 0."""
    return 1.0 - np.clip(a @ b.T, -1.0, 1.0)


def _pair_blocks(pdf: pd.DataFrame):
    """(query rows, reference rows) index pairs to compare in this task."""
    a, b = int(pdf["_pa"].iloc[0]), int(pdf["_pb"].iloc[0])
    tile = pdf["_tile"].to_numpy()
    if a == b:
        idx = np.arange(len(pdf))
        yield idx, idx
    else:
        ia, ib = np.nonzero(tile == a)[0], np.nonzero(tile == b)[0]
        yield ia, ib
        yield ib, ia


def _cross(rows: DataFrame, block: Sequence[str], tile_rows: int) -> DataFrame:
    """Rows marked ``_r`` (reference) or not (query): every tile of queries meets every tile of
    references of its block once, as (``_qt``, ``_rt``)."""
    size = max(tile_rows, min(CROSS_TILES * tile_rows, CROSS_ROWS))
    ntiles = lambda mark: F.ceil(F.count_if(mark) / F.lit(size)).cast("int")
    sizes = rows.groupBy(*block).agg(ntiles(~F.col("_r")).alias("_nq"), ntiles(F.col("_r")).alias("_nr"))
    # one row per block, as in _tile; a block without queries or references goes
    sizes = sizes.filter("_nq > 0 AND _nr > 0")
    x = rows.join(sizes, list(block)) if block else rows.crossJoin(sizes)
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("_r"), F.col("_nq")).otherwise(F.col("_nr")) - 1)).alias("_other")
    own = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.when(F.col("_r"), F.col("_nr")).otherwise(F.col("_nq"))).cast("int")
    x = x.select("*", own.alias("_own"), other)
    return x.withColumns({"_qt": F.when(F.col("_r"), F.col("_other")).otherwise(F.col("_own")),
                          "_rt": F.when(F.col("_r"), F.col("_own")).otherwise(F.col("_other"))}).drop("_own", "_other", "_nq", "_nr")


def _strips(rows: np.ndarray):
    for at in range(0, len(rows), STRIP_ROWS):
        yield rows[at:at + STRIP_ROWS]


def _nearest_kernel(order_cols, ascending, earlier_only):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.reset_index(drop=True)
        rank = _local_rank(pdf, order_cols, ascending)
        unit = _unit(pdf["_vec"].tolist())
        is_r = pdf["_r"].to_numpy(dtype=bool)
        ids = pdf["_id"].to_numpy()
        queries, refs = np.nonzero(~is_r)[0], np.nonzero(is_r)[0]
        out_q, out_r, out_d = [], [], []
        # tie on distance -> lowest reference id: order refs by id first
        ri = refs[np.argsort(ids[refs], kind="mergesort")]
        for qi in _strips(queries):
            if not len(ri):
                break
            d = _distances(unit[qi], unit[ri])
            # NaN (zero vector) sorts after every number, as in the store's ORDER BY
            d[np.isnan(d)] = _NAN_SLOT
            mask = ids[ri][None, :] != ids[qi][:, None]
            if earlier_only:
                mask &= rank[ri][None, :] < rank[qi][:, None]
            d[~mask] = np.inf
            j = np.argmin(d, axis=1)
            best = d[np.arange(len(qi)), j]
            keep = np.isfinite(best)
            out_q.append(ids[qi][keep])
            out_r.append(ids[ri][j][keep])
            # an undefined distance stays the largest number until the tile pairs are merged:
            # as NaN it would arrive as a null and sort first
            out_d.append(best[keep])
        if not out_q:
            return pd.DataFrame({"_id": ids[:0], "_nid": ids[:0], "_d": np.zeros(0)})
        return pd.DataFrame({"_id": np.concatenate(out_q), "_nid": np.concatenate(out_r), "_d": np.concatenate(out_d)})

    return run


def _edge_kernel(threshold):
    """Pairs within the threshold as places in the queue, the earlier row first."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.reset_index(drop=True)
        pos = pdf["_pos"].to_numpy()
        unit = _unit(pdf["_vec"].tolist())
        src, dst = [pos[:0]], [pos[:0]]
        for qi, ri in _pair_blocks(pdf):
            if not len(qi) or not len(ri):
                continue
            q, r = np.nonzero((_distances(unit[qi], unit[ri]) <= threshold) & (pos[ri][None, :] < pos[qi][:, None]))
            src.append(pos[ri][r]), dst.append(pos[qi][q])
        return pd.DataFrame({"_src": np.concatenate(src), "_dst": np.concatenate(dst)})

    return run


def _cover_kernel(threshold):
    """Places of the queries that have a reference within the threshold."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        unit = _unit(pdf["_vec"].tolist())
        is_r = pdf["_r"].to_numpy(dtype=bool)
        pos = pdf["_pos"].to_numpy()
        queries, refs = np.nonzero(~is_r)[0], unit[is_r]
        out = [np.zeros(0, dtype=np.int64)]
        for qi in _strips(queries):
            if len(refs):
                out.append(pos[qi][(_distances(unit[qi], refs) <= threshold).any(axis=1)].astype(np.int64))
        return pd.DataFrame({"_g": np.concatenate(out)})

    return run


def _order_spec(order: Sequence[tuple[str, bool]] | None, id_col: str):
    order = list(order or []) + [(id_col, True)]
    cols = [c for c, _ in order]
    return cols, [a for _, a in order]


def _prepare(df: DataFrame, block, id_col, vec_col, order_cols, extra: dict) -> DataFrame:
    cols = [F.col(c) for c in block] + [F.col(id_col).alias("_id"), F.col(vec_col).alias("_vec")]
    cols += [F.col(c).alias(f"_o_{c}") for c in order_cols if c != id_col]
    return df.select(*cols, *[v.alias(k) for k, v in extra.items()])


def nearest_neighbours(queries: DataFrame, refs: DataFrame, block: Sequence[str], id_col: str, vec_col: str,
                       order: Sequence[tuple[str, bool]] | None = None, earlier_only: bool = True,
                       prior_refs: DataFrame | None = None, tile_rows: int = DEFAULT_TILE_ROWS) -> DataFrame:
    """For each query row, the reference row with the smallest cosine
    distance (ties: lowest id) in the same block; with ``earlier_only`` the
    reference must come earlier in queue order (prior refs always do).
    Returns (id, nearest_id, distance) for queries with a neighbour."""
    order_cols, asc = _order_spec(order, id_col)
    loc_cols = [f"_o_{c}" if c != id_col else "_id" for c in order_cols]
    q = _prepare(queries, block, id_col, vec_col, order_cols, {"_r": F.lit(False), "_prior": F.lit(False)})
    r = _prepare(refs, block, id_col, vec_col, order_cols, {"_r": F.lit(True), "_prior": F.lit(False)})
    rows = q.unionByName(r)
    if prior_refs is not None:
        p = _prepare(prior_refs, block, id_col, vec_col, [id_col], {"_r": F.lit(True), "_prior": F.lit(True)})
        for c in order_cols:
            if c != id_col:
                p = p.withColumn(f"_o_{c}", F.lit(None).cast(rows.schema[f"_o_{c}"].dataType))
        rows = rows.unionByName(p)
    tiled = _cross(rows, block, tile_rows)
    id_type = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {id_type}, _nid {id_type}, _d double"
    part = tiled.groupBy(*block, "_qt", "_rt").applyInPandas(_nearest_kernel(loc_cols, asc, earlier_only), schema)
    best = part.groupBy("_id").agg(F.min_by(F.struct("_nid", "_d"), F.struct("_d", "_nid")).alias("b"))
    return best.select(F.col("_id").alias(id_col), F.col("b._nid").alias("nearest_id"),
                       F.when(F.col("b._d") == float(_NAN_SLOT), F.lit(float("nan"))).otherwise(F.col("b._d")).alias("distance"))


def _is_zero(vec: str) -> Column:
    return F.forall(F.col(vec), lambda x: x == 0)


def _queue(order: Sequence[tuple[str, bool]] | None, id_col: str) -> list[Column]:
    cols, ascending = _order_spec(order, id_col)
    return [F.col(c).asc_nulls_first() if a else F.col(c).desc_nulls_last() for c, a in zip(cols, ascending)]


def _first_of(df: DataFrame, keys: Sequence[str], queue: Sequence[Column]) -> DataFrame:
    """The first row of each key.  ``row_number() = 1`` is limited per key and task before
    the shuffle, so a hot key sends one row per task."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*queue))
    return df.withColumn("_rn", rn).filter("_rn = 1").drop("_rn")


def _settle(edges: DataFrame) -> tuple[DataFrame, int]:
    """Greedy statuses from (``_src`` earlier than ``_dst``) pairs: an end without an earlier
    neighbour left is accepted and rejects its later ones; both leave with their pairs.  Every
    round settles at least the earliest row left, so the loop ends by itself; ends that lose
    all their pairs without a verdict are accepted (they appear as ``_src`` or not at all).
    Returns the rejected ids and the number of rounds."""
    rejected, rounds = None, 0
    left = edges.checkpoint(eager=True)
    while not left.isEmpty():
        rounds += 1
        waiting = left.select(F.col("_dst").alias("_w")).distinct()
        free = left.join(waiting, left["_src"] == waiting["_w"], "left_anti")
        gone = free.select(F.col("_dst").alias("_g")).distinct().checkpoint(eager=True)
        rejected = gone if rejected is None else rejected.unionByName(gone)
        left = left.join(gone, left["_dst"] == gone["_g"], "left_anti")
        left = left.join(gone, left["_src"] == gone["_g"], "left_anti").checkpoint(eager=True)
    return (edges.select(F.col("_dst").alias("_g")).limit(0) if rejected is None else rejected), rounds


def _places(df: DataFrame, order_cols: Sequence[str], ascending: Sequence[bool]) -> DataFrame:
    """Adds ``_pos``, a number that grows along the queue (equal keys share it; nulls come last,
    as in ``_local_rank``): the range's number and the rank in it."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    queue = [F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last() for c, a in zip(order_cols, ascending)]
    ranged = df.repartitionByRange(n, *queue).withColumn("_pid", F.spark_partition_id())
    rank = F.dense_rank().over(Window.partitionBy("_pid").orderBy(*queue))
    return ranged.withColumn("_pos", F.shiftleft(F.col("_pid").cast("long"), 33) + rank).drop("_pid")


def _covered(queries: DataFrame, refs: DataFrame, keys: Sequence[str], threshold: float, tile_rows: int) -> DataFrame:
    """``_g``: places of the queries within the threshold of a reference of their block."""
    cols = [*keys, "_id", "_vec", "_pos"]
    rows = queries.select(*cols, F.lit(False).alias("_r")).unionByName(refs.select(*cols, F.lit(True).alias("_r")))
    return _cross(rows, keys, tile_rows).groupBy(*keys, "_qt", "_rt").applyInPandas(_cover_kernel(threshold), "_g long").distinct()


def _accept(queue: DataFrame, keys: Sequence[str], threshold: float, tile_rows: int, head_rows: int) -> tuple[DataFrame, int]:
    """G2 on distinct vectors: (the accepted rows, number of rounds).

    Each round takes a head of the queue (all blocks together), settles it by its own pairs, and removes
    all later rows that its accepted rows cover.  The pairs of a round are bounded by the head, and all other comparisons are those of
    a row with an accepted one before it."""
    none = queue.limit(0)
    kept, left, rounds, size = [], queue, 0, head_rows
    while n := left.count():
        rounds += 1
        head, later = left, None
        if n > size:
            cut = left.agg(F.percentile_approx("_pos", size / n, 10_000)).first()[0]
            head, later = left.filter(F.col("_pos") <= cut), left.filter(F.col("_pos") > cut)
        tiled = _to_pairs(_tile(head, keys, "_id", tile_rows))
        pairs = tiled.groupBy(*keys, "_pa", "_pb").applyInPandas(_edge_kernel(threshold), "_src long, _dst long").checkpoint(eager=True)
        rejected, _ = _settle(pairs)
        new = head.join(rejected, head["_pos"] == rejected["_g"], "left_anti").checkpoint(eager=True)
        kept.append(new)
        if later is None:
            break
        gone = _covered(later, new, keys, threshold, tile_rows)
        left = later.join(gone, later["_pos"] == gone["_g"], "left_anti").checkpoint(eager=True)
        if size < HEAD_GROWTH * head_rows and pairs.count() <= FEW_PAIRS * size:
            size *= 2
    return reduce(DataFrame.unionByName, kept, none), rounds


def semantic_greedy_dedup(cands: DataFrame, block: Sequence[str], id_col: str, vec_col: str, threshold: float,
                          order: Sequence[tuple[str, bool]] | None = None, prior_accepted: DataFrame | None = None,
                          tile_rows: int = DEFAULT_TILE_ROWS, head_rows: int = HEAD_ROWS) -> tuple[DataFrame, int]:
    """In queue order, accept a candidate iff no accepted embedding
    (earlier candidate or prior store row) is within ``threshold`` (inclusive).

    Equal vectors: whatever the first of them meets, the later ones meet too, so only
    the first takes part in the pairs and the others are duplicates.

    A zero vector has no distance to anything.  A candidate whose distances to all
    accepted rows are undefined is an error: a zero vector with anything accepted before
    it, and any row of a block in which only zero vectors are accepted, which happens if
    the store holds no other or if the first candidate of a block without a store is zero.

    Returns ((id, status accepted, rejected or error), rounds)."""
    ensure_checkpoint_dir(cands.sparkSession)
    keys = list(block) or ["_blk"]
    order_cols, asc = _order_spec(order, id_col)
    loc_cols = [f"_o_{c}" if c != id_col else "_id" for c in order_cols]
    queue = _queue(order, id_col)
    rows = cands.withColumn("_zero", _is_zero(vec_col))
    rows = rows if block else rows.withColumn("_blk", F.lit(0))
    first = _first_of(rows, keys, queue).select(*keys, F.col(id_col).alias("_first"), F.col("_zero").alias("_first_zero"))
    if prior_accepted is not None:
        store = prior_accepted if block else prior_accepted.withColumn("_blk", F.lit(0))
        held = store.groupBy(*keys).agg(F.bool_or(~_is_zero(vec_col)).alias("_store"))
        first = first.join(held, keys, "left")
    else:
        store, first = None, first.withColumn("_store", F.lit(None).cast("boolean"))
    # one row per block
    mode = (F.when(F.col("_store"), F.lit("pairs")).when(F.col("_store").isNotNull(), F.lit("none"))
            .when(F.col("_first_zero"), F.lit("first")).otherwise(F.lit("pairs")))
    first = first.select(*keys, "_first", mode.alias("_mode")).checkpoint(eager=True)
    rows = rows.join(first, keys)
    usable = rows.filter((F.col("_mode") == "pairs") & ~F.col("_zero"))
    hashed = usable.withColumn("_h1", F.xxhash64(vec_col)).withColumn("_h2", F.xxhash64(F.lit(1), vec_col))
    reps = _first_of(hashed, [*keys, "_h1", "_h2"], queue)
    base = _places(_prepare(reps, keys, id_col, vec_col, order_cols, {}), loc_cols, asc).select(*keys, "_id", "_vec", "_pos").checkpoint(eager=True)
    if store is not None:
        p = _prepare(store.filter(~_is_zero(vec_col)), keys, id_col, vec_col, [id_col], {"_pos": F.lit(-1).cast("long")})
        by_store = _covered(base, p.join(first.select(*keys), keys, "left_semi"), keys, threshold, tile_rows)
        base = base.join(by_store, base["_pos"] == by_store["_g"], "left_anti").checkpoint(eager=True)
    kept, rounds = _accept(base, keys, threshold, tile_rows, head_rows)
    kept = kept.select(F.col("_id").alias("_kept"))
    verdict = (F.when((F.col("_mode") == "first") & (F.col(id_col) == F.col("_first")), F.lit("accepted"))
               .when((F.col("_mode") != "pairs") | F.col("_zero"), F.lit("error"))
               .when(F.col("_kept").isNotNull(), F.lit("accepted")).otherwise(F.lit("rejected")))
    out = rows.select(id_col, "_mode", "_first", "_zero").join(kept, F.col(id_col) == F.col("_kept"), "left")
    return out.select(id_col, verdict.alias("status")).checkpoint(eager=True), rounds


def semantic_dedup_with_evidence(cands: DataFrame, block: Sequence[str], id_col: str, vec_col: str,
                                 threshold: float, dim: int, order: Sequence[tuple[str, bool]] | None = None,
                                 prior_accepted: DataFrame | None = None,
                                 tile_rows: int = DEFAULT_TILE_ROWS) -> tuple[DataFrame, int]:
    """G2 + G3 + B11: status, failure code and nearest-accepted evidence.

    Invalid embeddings fail closed (``semantic_dedup_error``).  Evidence for
    each candidate is its nearest accepted neighbour earlier in queue order
    (or prior), kept even when the candidate is accepted; an undefined
    distance comes after every number."""
    ok = embedding_ok(F.col(vec_col), dim)
    good = cands.filter(ok)
    bad = cands.filter(~ok).select(id_col, F.lit(codes.REJECTED).alias("status"),
                                   F.lit(codes.SEMANTIC_DEDUP_ERROR).alias("failure_code"))
    status, rounds = semantic_greedy_dedup(good, block, id_col, vec_col, threshold, order, prior_accepted, tile_rows)
    accepted = good.join(status.filter(F.col("status") == "accepted").select(id_col), id_col, "left_semi")
    near = nearest_neighbours(good, accepted, block, id_col, vec_col, order, True, prior_accepted, tile_rows)
    out = status.join(near, id_col, "left").select(
        id_col, F.when(F.col("status") == "accepted", F.lit(codes.ACCEPTED)).otherwise(F.lit(codes.REJECTED)).alias("status"),
        "nearest_id", "distance",
        F.when(F.col("status") == "rejected", F.lit(codes.DUPLICATE_SAMPLE))
        .when(F.col("status") == "error", F.lit(codes.SEMANTIC_DEDUP_ERROR)).alias("failure_code"))
    return out.unionByName(bad, allowMissingColumns=True), rounds


def top1_against(df: DataFrame, query_vec: DataFrame, id_col: str, vec_col: str, exclude_id: bool = True) -> DataFrame:
    """The row nearest to one query vector, ties by lowest id.

    The single query row is fetched (one vector, bounded) and becomes a
    literal, so the scan feeds a partial ``min_by`` aggregate directly: no
    join, no sort."""
    from ..functions.vectors import cosine_distance

    row = query_vec.select(id_col, vec_col).limit(1).collect()
    if not row:
        return df.sparkSession.createDataFrame([], f"query_id {df.schema[id_col].dataType.simpleString()}, "
                                                   f"nearest_id {df.schema[id_col].dataType.simpleString()}, distance double")
    qid, qv = row[0][0], row[0][1]
    x = df.filter(F.col(id_col) != F.lit(qid)) if exclude_id else df
    qlit = F.array(*[F.lit(float(v)) for v in qv])
    x = x.withColumn("_d", cosine_distance(F.col(vec_col), qlit))
    b = x.agg(F.min_by(F.struct(F.col(id_col).alias("nearest_id"), F.col("_d").alias("distance")),
                       F.struct("_d", id_col)).alias("b"))
    return b.select(F.lit(qid).alias("query_id"), "b.nearest_id", "b.distance")
