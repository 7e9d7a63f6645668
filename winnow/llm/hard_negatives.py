"""Hard-negative mining over Hilbert-ordered candidate blocks with zone maps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import gapless_rank, written

#: Rows of a block; blocks whose zones are looked at together; anchors of a tile.
BLOCK_ROWS, PAGE_BLOCKS, TILE_ANCHORS = 512, 1024, 4096
#: Components that the curve runs through (those that vary most), and bits of each.
CURVE_DIMS, CURVE_BITS = 12, 5
#: Best blocks of a page that each anchor reads before its bounds are known.
SEED_BLOCKS = 4
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cell numbers (n, d), below 2^bits, on the Hilbert curve; d * bits <= 63.

    The published transform of axes to the curve: each level's bits reflect or exchange the lower
    bits of the axes, a Gray code over the axes follows, and the bits are interleaved.
    """
    x = cells.astype(np.int64).copy()
    d = x.shape[1]
    if d == 0:
        return np.zeros(len(x), dtype=np.int64)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(d):
            reflect = (x[:, i] >> bit & 1).astype(bool)
            swap = np.where(reflect, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(reflect, low, swap)
            x[:, i] ^= swap
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), dtype=np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, d - 1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(len(x), dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[:, i] >> bit & 1)
    return key


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``, whole numbers of 64 bits."""
    most = lambda m: max(abs(int(m.min(initial=0))), abs(int(m.max(initial=0))))
    bound = a.shape[1] * most(a) * most(b)
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2**63:
        return a @ b.T
    raise ValueError("components too large: a score could leave 64 bits")


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each anchor with any vector of each zone, by interval arithmetic."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(plus, low) + products(minus, high), products(plus, high) + products(minus, low)


def _numbers(column: pd.Series) -> np.ndarray:
    return np.stack([np.frombuffer(b, dtype=np.int64) for b in column])


def _statistics(rows: DataFrame) -> dict[int, tuple[list[int], list[float], list[float]]]:
    """Of each vector length: the components that vary most, and their least and largest values.
    Each task sends one row for each length and component."""
    def partial(batches):
        held: dict[int, list] = {}
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                if dim:
                    v = np.stack(part["vector"]).astype(np.float64)
                    new = [len(v), v.min(0), v.max(0), v.sum(0), (v * v).sum(0)]
                    old = held.get(dim)
                    held[dim] = new if old is None else [old[0] + new[0], np.minimum(old[1], new[1]), np.maximum(old[2], new[2]),
                                                         old[3] + new[3], old[4] + new[4]]
        for dim, (n, lo, hi, s, q) in held.items():
            yield pd.DataFrame({"dim": dim, "axis": np.arange(dim), "n": n, "lo": lo, "hi": hi, "s": s, "q": q})

    parts = rows.select("dim", "vector").mapInPandas(partial, "dim int, axis int, n long, lo double, hi double, s double, q double")
    whole = parts.groupBy("dim", "axis").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                             F.sum("s").alias("s"), F.sum("q").alias("q"))
    spread = F.col("q") / F.col("n") - (F.col("s") / F.col("n")) ** 2
    first = Window.partitionBy("dim").orderBy(F.desc("spread"), "axis")
    kept = whole.withColumn("spread", spread).withColumn("r", F.row_number().over(first)).filter(F.col("r") <= CURVE_DIMS)
    out: dict[int, tuple[list, list, list]] = {}
    for r in kept.orderBy("dim", "r").collect():  # a dozen rows for each vector length
        for held, value in zip(out.setdefault(r["dim"], ([], [], [])), (r["axis"], r["lo"], r["hi"])):
            held.append(value)
    return out


def _curve(stats: dict) -> Column:
    @F.pandas_udf("long")
    def place(dim: pd.Series, vector: pd.Series) -> pd.Series:
        out = np.zeros(len(dim), dtype=np.int64)
        for d in dim.unique():
            if d in stats:
                axes, lo, hi = stats[d]
                own = (dim == d).to_numpy()
                v = np.stack(vector[own])[:, axes].astype(np.float64)
                width = np.maximum(np.array(hi) - np.array(lo), 1.0)
                cells = np.minimum((v - np.array(lo)) / width * 2**CURVE_BITS, 2**CURVE_BITS - 1).astype(np.int64)
                out[own] = hilbert_key(cells, CURVE_BITS)
        return pd.Series(out)

    return place("dim", "vector")


def build_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(ordered rows, blocks), both written.  ``rows`` has id, label, vector (array<long>).

    Rows are ordered by vector length, label and place on the curve and cut into blocks, one for
    each length where lengths meet; a block's Parquet row holds its zone map (least and largest
    label and component) beside its rows.
    """
    rows = written(rows.withColumn("dim", F.size("vector")), "negatives-rows")
    keyed = rows.withColumn("curve", _curve(_statistics(rows)))
    ranked = gapless_rank(keyed, [], [F.col("dim"), F.col("label"), F.col("curve"), F.col("id")], "at")
    ranked = written(ranked.withColumn("block", F.floor(F.col("at") / block_rows)), "negatives-ordered")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        v = np.stack(pdf["vector"]).astype(np.int64).reshape(len(pdf), -1)
        flat = lambda a: [np.ascontiguousarray(a, dtype=np.int64).tobytes()]
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1].to_numpy(), "block": pdf["block"].iloc[:1].to_numpy(),
                             "label_lo": [pdf["label"].min()], "label_hi": [pdf["label"].max()], "lo": flat(v.min(0)), "hi": flat(v.max(0)),
                             "ids": flat(pdf["id"]), "labels": flat(pdf["label"]), "places": flat(pdf["at"]), "vectors": flat(v)})

    packed = ranked.select("dim", "block", "at", "id", "label", "vector").groupBy("dim", "block").applyInPandas(
        pack, "dim int, block long, label_lo long, label_hi long, lo binary, hi binary, ids binary, labels binary, places binary, vectors binary")
    return ranked, written(packed, "negatives-blocks")


def _windows(asked: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, high, floor), a row for each anchor and a column for each window; missing ones are empty."""
    most = max(map(len, asked["low"]), default=0)
    pad = lambda column, value: np.array([[*x, *[value] * (most - len(x))] for x in column], dtype=np.int64).reshape(len(asked), most)
    return pad(asked["low"], HIGHEST), pad(asked["high"], LOWEST), pad(asked["floor"], LOWEST)


def _open(anchors: pd.DataFrame, same: bool, zones: pd.DataFrame, least: np.ndarray, most: np.ndarray, floors: bool) -> np.ndarray:
    """Which zones (columns) may hold a row that a window of an anchor (row) still wants."""
    label = anchors["label"].to_numpy()[:, None]
    lo, hi = zones["label_lo"].to_numpy(), zones["label_hi"].to_numpy()
    fits = (lo <= label) & (label <= hi) if same else (lo != label) | (hi != label)
    wanted = np.zeros(fits.shape, dtype=bool)
    for low, high, floor in zip(*(m.T[:, :, None] for m in _windows(anchors))):
        wanted |= (most >= (np.maximum(low, floor) if floors else low)) & (least <= high)
    return fits & wanted


_ASKED = ["dim", "tile", "anchor", "label", "vector", "low", "high", "floor"]


def choose_blocks(blocks: DataFrame, asked: DataFrame, pages: Column, tiles: Column, same: bool, seed: bool) -> DataFrame:
    """``asked`` rows with each block that they must read.

    A tile of anchors meets a page of zone maps in a task of its own; ``pages`` and ``tiles`` say how many
    there are.  ``seed`` chooses, of the blocks that a window may reach, each anchor's few with the
    largest bound; without it, all others whose bound also reaches the floor of a window, the
    score it has to beat by now.
    """
    names = [*_ASKED, "block"]

    def choose(zones: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        if not len(zones) or not len(anchors):
            return pd.DataFrame(columns=names, dtype=object)
        least, most = bounds(_numbers(anchors["vector"]), _numbers(zones["lo"]), _numbers(zones["hi"]))
        reach = _open(anchors, same, zones, least, most, False)
        order = np.lexsort((np.broadcast_to(zones["block"].to_numpy(), most.shape), -most, ~reach), axis=1)[:, :SEED_BLOCKS]
        first = np.zeros(reach.shape, dtype=bool)
        np.put_along_axis(first, order, True, axis=1)
        picked = reach & first if seed else reach & ~first & _open(anchors, same, zones, least, most, True)
        who, where = np.nonzero(picked)
        return anchors.iloc[who].assign(block=zones["block"].to_numpy()[where])[names]

    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    zones = blocks.select("dim", "block", "label_lo", "label_hi", "lo", "hi", F.floor(F.col("block") / PAGE_BLOCKS).alias("page"), upto(tiles).alias("tile"))
    spread = asked.select(*_ASKED, upto(pages).alias("page"))
    return zones.groupBy("dim", "page", "tile").cogroup(spread.groupBy("dim", "page", "tile")).applyInPandas(
        choose, "dim int, tile long, anchor long, label long, vector binary, low array<long>, high array<long>, floor array<long>, block long")


def read_blocks(blocks: DataFrame, chosen: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor, w, score, id, at): of each chosen block the up to ``k`` first rows in each window of
    each anchor, at or above its floor.  Only chosen blocks are read past their zone map."""
    def read(block: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = [(np.zeros(0, dtype=np.int64),) * 5]
        if len(block) and len(anchors):
            b = block.iloc[0]
            ids, labels, places = (np.frombuffer(b[c], dtype=np.int64) for c in ("ids", "labels", "places"))
            scores = products(_numbers(anchors["vector"]), np.frombuffer(b["vectors"], dtype=np.int64).reshape(len(ids), -1))
            anchor, label = anchors["anchor"].to_numpy(), anchors["label"].to_numpy()[:, None]
            fits = (labels == label) & (places != anchor[:, None]) if same else labels != label
            for w, (low, high, floor) in enumerate(zip(*(m.T[:, :, None] for m in _windows(anchors)))):
                who, at = np.nonzero(fits & (scores >= np.maximum(low, floor)) & (scores <= high))
                s = scores[who, at]
                order = np.lexsort((places[at], ids[at], -s, who))
                who, at, s = who[order], at[order], s[order]
                first = np.arange(len(who)) - np.searchsorted(who, who) < k
                who, at, s = who[first], at[first], s[first]
                out.append((anchor[who], np.full(len(who), w), s, ids[at], places[at]))
        return pd.DataFrame(dict(zip(("anchor", "w", "score", "id", "at"), map(np.concatenate, zip(*out)))))

    work = chosen.select(F.col("dim").alias("d"), F.col("tile").alias("t"), F.col("block").alias("b")).distinct()
    wanted = blocks.select("dim", "block", "ids", "labels", "places", "vectors").join(
        work, (F.col("dim") == F.col("d")) & (F.col("block") == F.col("b"))).drop("d", "b")
    return wanted.groupBy("dim", "t", "block").cogroup(chosen.groupBy("dim", "tile", "block")).applyInPandas(
        read, "anchor long, w int, score long, id long, at long")


def _first(found: DataFrame, k: int) -> DataFrame:
    in_order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id", "at")
    return found.withColumn("r", F.row_number().over(in_order)).filter(F.col("r") <= k)


def search(blocks: DataFrame, asked: DataFrame, pages: Column, tiles: Column, k: int, same: bool) -> DataFrame:
    """(anchor, w, score, id, at, r): the first ``k`` rows of each window of each anchor, exactly.

    A window holds scores from ``low`` to ``high`` of rows with the anchor's label (``same``) or another
    one.  The blocks with the best bounds are read first; the ``k``-th score found is the floor that
    the bounds of all other blocks must reach to be read.
    """
    begun = written(_first(read_blocks(blocks, written(choose_blocks(blocks, asked, pages, tiles, same, True), "negatives-chosen"), k, same), k), "negatives-seeds")
    floors = begun.filter(F.col("r") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("floors"))
    raised = asked.drop("floor").join(floors, "anchor", "left").withColumn(
        "floor", F.transform("low", lambda _, w: F.coalesce(F.element_at("floors", w), F.lit(LOWEST).cast("long"))))
    rest = read_blocks(blocks, written(choose_blocks(blocks, raised, pages, tiles, same, False), "negatives-chosen"), k, same)
    return written(_first(begun.drop("r").unionByName(rest), k), "negatives-found")


def mine_hard_negatives(df: DataFrame, is_anchor: Column, label: Column, vec_id: str = "vec_id", vector: str = "embedding", positives: int = 5,
                        negatives: int = 10, least_percent: int = 30, most_percent: int = 90, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Each component x becomes floor(256 * x); a row's score is its whole-number inner product with
    the anchor.  An anchor's positives are the first rows of its label but itself, and a pair's
    negatives the first rows of other labels with ``least_percent`` to ``most_percent`` of the positive's
    score; higher scores first, ties by smaller id.  All candidates count: what zone maps
    rule out is never read.  Rows without an id, a label or a vector, or with a null or
    non-finite component take no part; vectors of different lengths do not meet.  Repeated
    rows, and rows that share an id, are rows of their own; equal scores of one id come in the
    order of the blocks.  An empty vector scores 0.  A score that could leave 64 bits raises ValueError.
    """
    spark = df.sparkSession
    number = F.col(f"`{vector}`").cast("array<double>")
    fine = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), label.cast("long").alias("label"),
                     F.when(number.isNotNull() & fine, F.transform(number, lambda x: F.floor(x * 256))).alias("vector"),
                     F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    ranked, blocks = build_blocks(rows.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL"), block_rows)
    anchors = gapless_rank(ranked.filter("asks").select("dim", "at", "id", "label", "vector"), [], [F.col("dim"), F.col("at")], "no")

    @F.pandas_udf("binary")
    def flat(v: pd.Series) -> pd.Series:
        return v.map(lambda x: np.asarray(x, dtype=np.int64).tobytes())

    whole = lambda n: F.array(F.lit(n).cast("long"))
    asked = written(anchors.select("dim", F.floor(F.col("no") / TILE_ANCHORS).alias("tile"), F.col("at").alias("anchor"), "id", "label",
                                   flat("vector").alias("vector"), whole(LOWEST).alias("low"), whole(HIGHEST).alias("high"),
                                   whole(LOWEST).alias("floor")), "negatives-anchors")
    most = blocks.agg(F.max("block")).first()[0], asked.agg(F.max("tile")).first()[0]
    if None in most:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    pages, tiles = F.lit(most[0] // PAGE_BLOCKS + 1).cast("long"), F.lit(most[1] + 1).cast("long")

    near = search(blocks, asked, pages, tiles, positives, same=True)
    pairs = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("positives"))
    rounded = "transform(positives, p -> {sign}(({sign}{percent}L * p.score - pmod({sign}{percent}L * p.score, 100L)) div 100L))"
    asked = written(asked.drop("low", "high", "floor").join(pairs, "anchor").withColumns({
        "low": F.expr(rounded.format(sign="-", percent=least_percent)), "high": F.expr(rounded.format(sign="", percent=most_percent)),
        "floor": F.transform("positives", lambda p: F.lit(LOWEST).cast("long"))}), "negatives-windows")
    far = search(blocks, asked, pages, tiles, negatives, same=False)
    out = far.join(asked.select("anchor", F.col("id").alias("anchor_id"), "positives"), "anchor").withColumn("p", F.expr("positives[w]"))
    return out.select("anchor_id", F.col("p.id").alias("positive_id"), F.col("r").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                      F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))
