"""Semantic greedy dedup against the plain queue loop (G2, D1, G3): exact copies, zero
vectors, several blocks, a prior store, any tile size, any input order."""

import numpy as np
import pytest

from winnow.functions import codes


def queue_loop(cands, prior, threshold):
    """cands: (block, id, priority, vector) ; prior: (block, id, vector)."""
    def unit(v):
        v = np.asarray(v, dtype=np.float64)
        n = np.linalg.norm(v)
        return v / n if n else v * np.nan

    held = {}
    for b, i, v in prior:
        held.setdefault(b, []).append((i, unit(v)))
    out = {}
    for b, i, p, v in sorted(cands, key=lambda r: (-r[2], r[1])):
        u, acc = unit(v), held.setdefault(b, [])
        near = [(1.0 - min(1.0, max(-1.0, float(u @ a))) if not (np.isnan(u).any() or np.isnan(a).any()) else np.inf, j) for j, a in acc]
        if not near:
            out[i] = (codes.ACCEPTED, None, None)
            acc.append((i, u))
            continue
        d, j = min(near)
        if d == np.inf:
            out[i] = (codes.REJECTED, codes.SEMANTIC_DEDUP_ERROR, j)
        elif d <= threshold:
            out[i] = (codes.REJECTED, codes.DUPLICATE_SAMPLE, j)
        else:
            out[i] = (codes.ACCEPTED, None, j)
            acc.append((i, u))
    return out


def _data(seed):
    rng = np.random.default_rng(seed)
    vec = lambda c: [float(x) for x in np.float32(c + 0.4 * rng.normal(size=6))]
    centers = rng.normal(size=(5, 6))
    cands, i = [], 0
    for b in ("a", "b", "c"):
        for _ in range(30):
            v = vec(centers[rng.integers(5)])
            cands.append((b, i, int(rng.integers(3)), v))
            i += 1
            if rng.random() < 0.4:  # exact copy
                cands.append((b, i, int(rng.integers(3)), v))
                i += 1
        cands.append((b, i, int(rng.integers(3)), [0.0] * 6))
        i += 1
    cands += [("zero first", i, 9, [0.0] * 6)] + [("zero first", i + k, 1, vec(centers[k])) for k in (1, 2, 3)]
    i += 4
    cands += [("zero store", i, 1, vec(centers[0])), ("zero store", i + 1, 1, [0.0] * 6)]
    prior = [("b", 1000 + k, vec(centers[k])) for k in range(3)] + [("b", 1010, [0.0] * 6), ("zero store", 1020, [0.0] * 6), ("none", 1030, vec(centers[0]))]
    return cands, prior


@pytest.mark.parametrize("tile_rows", [1, 37, 4096])
def test_any_tile_size_equals_the_queue_loop(spark, tile_rows):
    from winnow.operators.similarity import semantic_dedup_with_evidence

    cands, prior = _data(3)
    want = queue_loop(cands, prior, 0.2)
    shuffled = [cands[k] for k in np.random.default_rng(tile_rows).permutation(len(cands))]
    df = spark.createDataFrame(shuffled, "ds string, id long, pr int, v array<double>").repartition(3)
    store = spark.createDataFrame(prior, "ds string, id long, v array<double>")
    out, _ = semantic_dedup_with_evidence(df, ["ds"], "id", "v", 0.2, 6, order=[("pr", False)], prior_accepted=store, tile_rows=tile_rows)
    got = {r.id: (r.status, r.failure_code, r.nearest_id) for r in out.collect()}
    assert got == want
    assert sum(c == codes.DUPLICATE_SAMPLE for _, c, _ in got.values()) > 30


def test_a_row_is_not_its_own_neighbour(spark):
    from winnow.operators.similarity import nearest_neighbours

    df = spark.createDataFrame([(k, [1.0, float(k)]) for k in range(20)], "id long, v array<double>")
    refs = df.orderBy("id", ascending=False)
    got = nearest_neighbours(df, refs, [], "id", "v").collect()
    assert {r.id for r in got} == set(range(1, 20)) and all(r.nearest_id < r.id for r in got)


@pytest.mark.parametrize("head_rows", [7, 40])
def test_any_head_size_equals_the_queue_loop(spark, head_rows):
    from winnow.operators.similarity import semantic_greedy_dedup

    cands, prior = _data(5)
    want = {i: s for i, (s, code, _) in queue_loop(cands, prior, 0.2).items() if code != codes.SEMANTIC_DEDUP_ERROR}
    df = spark.createDataFrame(cands, "ds string, id long, pr int, v array<double>").repartition(3)
    store = spark.createDataFrame(prior, "ds string, id long, v array<double>")
    out, rounds = semantic_greedy_dedup(df, ["ds"], "id", "v", 0.2, [("pr", False)], store, 37, head_rows)
    assert {r.id: r.status for r in out.collect() if r.status != "error"} == want and rounds > 1


def test_many_queries_meet_few_references_once(spark):
    """All rows against the accepted ones: each query goes to one tile of references, not to all tiles of rows."""
    from winnow.operators.similarity import _cross

    q = spark.range(4000).selectExpr("0 AS b", "id AS _id", "false AS _r")
    r = spark.range(5).selectExpr("0 AS b", "id AS _id", "true AS _r")
    met = _cross(q.unionByName(r), ["b"], 10)
    assert met.filter("NOT _r").count() == 4000 and met.filter("_r").count() == 5 * met.select("_qt").distinct().count()


def test_pairs_are_made_inside_a_head_only(spark, monkeypatch):
    """2,000 rows within the threshold of each other: the first head has pairs, the rest is covered by its one accepted row."""
    from winnow.operators import similarity

    made = []
    settle = similarity._settle
    monkeypatch.setattr(similarity, "_settle", lambda pairs: made.append(pairs.count()) or settle(pairs))
    df = spark.range(2000).selectExpr("id", "array(1.0D, id / 1e6) AS v")
    out, rounds = similarity.semantic_greedy_dedup(df, [], "id", "v", 0.1, head_rows=100)
    assert [r.id for r in out.filter("status = 'accepted'").collect()] == [0]
    assert rounds == 1 and sum(made) <= 103 * 102 / 2
