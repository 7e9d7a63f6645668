"""Hard negatives against brute force, the curve and the bounds of zone maps."""

import collections
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, block long, tile long, anchor long, score double"


def brute(rows, k_pos=5, k_neg=10):
    """Over rows (vec_id, vector, label); ties of score and id are cut anywhere, so only scores are exact there."""
    ok = [(i, v, la) for i, v, la in rows if i is not None and la is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v], (la + 1) % 10 if i % 7 == 0 else la) for i, v, la in ok]
    out = []
    for n, (i, v, la) in enumerate(ok):
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, lb == la) for m, (j, w, lb) in enumerate(ok) if m != n and len(w) == len(v)]
        for ps, pid, _ in sorted(s for s in scored if s[2])[:k_pos]:
            good = sorted(s for s in scored if not s[2] and 30 * -ps <= -100 * s[0] <= 90 * -ps)[:k_neg]
            out += [(i, pid, r + 1, nid, -ps, -ns) for r, (ns, nid, _) in enumerate(good)]
    return out


@pytest.mark.parametrize("bits,dims", [(1, 3), (2, 2), (3, 2), (2, 3), (4, 1)])
def test_the_curve_visits_neighbours(bits, dims):
    from winnow.llm.hard_negatives import hilbert_key

    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    key = hilbert_key(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    along = cells[np.argsort(key)]
    assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_are_reached():
    from winnow.llm.hard_negatives import bounds

    rng = np.random.default_rng(5)
    a, v = rng.integers(-50, 50, (7, 6)), rng.integers(-50, 50, (40, 6))
    least, most = bounds(a, v.min(0)[None], v.max(0)[None])
    inside = a @ v.T
    assert (least <= inside.min(1)[:, None]).all() and (inside.max(1)[:, None] <= most).all()
    least, most = bounds(a, v[:1], v[:1])
    assert (least[:, 0] == inside[:, 0]).all() and (most[:, 0] == inside[:, 0]).all()


def test_scores_are_exact_beyond_doubles():
    from winnow.llm.hard_negatives import products

    a = np.array([[2**31 - 1, 3]])
    assert products(a, a)[0, 0] == (2**31 - 1) ** 2 + 9
    with pytest.raises(ValueError):
        products(a << 20, a << 20)


def clustered(seed, n, dims=6, labels=10):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dims))
    rows = []
    for i in range(n):
        la = int(rng.integers(labels))
        rows.append((i, [float(x) for x in (centre[la] + rng.normal(size=dims) * 0.7).astype(np.float32)], la))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, la, 1, 1, 1, 1.0) for i, v, la in rows], SCHEMA)


def label():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


@pytest.mark.parametrize("block_rows", [4, 32])
def test_negatives_match_brute_force_on_awkward_rows(spark, block_rows, monkeypatch):
    from winnow.llm import hard_negatives as hn

    monkeypatch.setattr(hn, "PAGE_BLOCKS", 3)
    monkeypatch.setattr(hn, "TILE_ANCHORS", 2)
    rows = clustered(1, 320)
    hot = rows[3][1]
    rows += [(1000 + i, hot, 3) for i in range(40)] + [(2000 + i, hot, i % 10) for i in range(30)]  # equal vectors, ties
    rows += [(None, hot, 1), (5001, None, 1), (5002, hot, None), (5003, [1.0, None, 1.0, 0.0, 0.0, 0.0], 1), (5004, [math.nan] + hot[1:], 1),
             (5005, [math.inf] + hot[1:], 2), (5006, [0.0] * 6, 2), (3000, [0.0] * 6, 4)]
    rows += [(6000 + i, [1.0 + 0.15 * (i // 10), 0.5], i // 10 % 3) for i in range(0, 120, 10)] + [(7000 + 50 * i, [], i % 3) for i in range(6)]  # other lengths
    got = hn.mine_hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, label(), block_rows=block_rows).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute(rows))
    assert any(r[0] == 6000 for r in brute(rows)) and any(r[0] == 7000 for r in brute(rows))


def test_repeated_rows_and_ids_are_rows_of_their_own(spark):
    from winnow.llm import hard_negatives as hn

    rows = [(100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (100, [0.5, 0.5], 2), (1, [1.0, 1.0], 1), (2, [0.5, 0.25], 2), (2, [0.5, 0.25], 2), (3, [0.4, 0.1], 3)]
    got = hn.mine_hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, label()).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute(rows))


def test_empty_tables_and_no_anchor(spark):
    from winnow.llm import hard_negatives as hn

    for rows in ([], [(1, [1.0], 1)], [(100, None, 1)], [(100, [1.0], 1)]):
        assert hn.mine_hard_negatives(frame(spark, rows), F.col("vec_id") % 100 == 0, label()).count() == 0


def test_zone_maps_spare_blocks_of_clustered_vectors(spark):
    """On clustered vectors most blocks are never read past their zone map."""
    from pyspark.sql import functions as F
    from winnow.llm import hard_negatives as hn

    rows = clustered(2, 2000, dims=4, labels=40)
    rows = [(i, [x * 4 for x in v], la) for i, v, la in rows]
    data = frame(spark, rows).select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"),
                                     F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"), (F.col("vec_id") % 100 == 0).alias("asks"))
    ranked, blocks = hn.build_blocks(data, 32)
    one = F.lit(1).cast("long")
    top = np.array([hn.LOWEST])
    anchors = [(r.dim, 0, r["at"], r.label, bytearray(np.array(r.vector, dtype=np.int64).tobytes()), [hn.LOWEST], [hn.HIGHEST], top.tolist())
               for r in ranked.filter("asks").collect()]
    asked = spark.createDataFrame(anchors, "dim int, tile long, anchor long, label long, vector binary, low array<long>, high array<long>, floor array<long>")
    seeds = hn.choose_blocks(blocks, asked, one, one, False, True)
    begun = hn._first(hn.read_blocks(blocks, seeds, 10, False), 10)
    floor = {r.anchor: r.s for r in begun.groupBy("anchor").agg(F.min("score").alias("s")).collect()}
    raised = spark.createDataFrame([(*a[:7], [floor[a[2]]]) for a in anchors], asked.schema)
    read = seeds.count() + hn.choose_blocks(blocks, raised, one, one, False, False).count()
    assert read < 0.5 * len(anchors) * blocks.count()
    assert hn.search(blocks, asked, one, one, 10, False).count() == 10 * len(anchors)
