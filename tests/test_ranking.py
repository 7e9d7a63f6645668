"""Score-ranked selection, latency and lineage against plain loops."""

import math

import pytest
from pyspark.sql import functions as F


def brute_top(rows, share=None, n=None):
    by = {}
    for g, s, i in rows:
        if s is not None and not math.isnan(s):
            by.setdefault(g, []).append((-s, i))
    return {(g, i) for g, own in by.items() for _, i in sorted(own)[:n if n is not None else math.ceil(round(share * len(own), 6))]}


def hot_rows():
    rows = [("hot", float((i * 7919) % 40), i) for i in range(3000)]  # a third of all rows, few different scores
    rows += [("same", 1.5, i) for i in range(3000, 6000)]  # equal scores throughout
    rows += [(f"g{i % 300}", math.sin(i) * 1e6, i) for i in range(6000, 8500)]
    rows += [(None, float(i % 5), i) for i in range(8500, 8600)]
    rows += [("odd", s, 9000 + k) for k, s in enumerate([None, float("nan"), math.inf, -math.inf, 0.0, -0.0, 5e-324, 1.0])]
    return rows + [("none", None, 9100), ("none", float("nan"), 9101)]


@pytest.mark.parametrize("share,n", [(0.0, None), (0.1, None), (0.5, None), (0.9999, None), (1.0, None), (None, 0), (None, 1), (None, 37), (None, 10**6)])
def test_top_rows_match_sorting(spark, share, n):
    from winnow.operators.ranking import select_top

    rows = hot_rows()
    df = spark.createDataFrame(rows, "ds string, score double, id long").repartition(8)
    got = select_top(df, "ds", "score", "id", share=share, n=n).collect()
    assert len(got) == len(rows)
    assert {(r.ds, r.id) for r in got if r.selected} == brute_top(rows, share, n)


def test_only_the_border_is_ranked_and_no_task_holds_a_dataset(spark, monkeypatch):
    from winnow.operators import ranking

    seen = []
    plain = ranking.range_rank
    monkeypatch.setattr(ranking, "range_rank", lambda df, *a: seen.append(df.count()) or plain(df, *a))
    df = spark.range(40000).select(F.lit("one").alias("ds"), F.rand(3).alias("score"), F.col("id"))
    assert ranking.select_top(df, "ds", "score", "id", share=0.2).filter("selected").count() == 8000
    assert seen[0] < 0.05 * 40000
    equal = spark.range(8000).select(F.lit("one").alias("ds"), F.lit(1.0).alias("score"), F.col("id"))
    ranked = plain(equal, ["ds"], [F.col("score").desc(), F.col("id")], "r")
    assert ranked.groupBy(F.col("r") == F.col("id") + 1).count().collect()[0][0] is True
    sizes = equal.repartitionByRange(8, "ds", F.col("score").desc(), "id").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 0.3 * 8000


def test_bad_wishes_and_empty_tables(spark):
    from winnow.operators.ranking import select_top

    df = spark.createDataFrame([], "ds string, score double, id long")
    assert select_top(df, "ds", "score", "id", n=3).count() == 0
    for wish in ({}, {"share": 0.1, "n": 1}, {"share": 1.5}, {"n": -1}):
        with pytest.raises(ValueError):
            select_top(df, "ds", "score", "id", **wish)


def test_latency_of_every_output_adds_up(spark):
    from winnow.operators.score import latency_histogram, observed_latency, score

    class Slow:
        def predict(self, x):
            import time

            time.sleep(0.05)
            if (x[:, 0] < 0).any():
                raise RuntimeError("negative")
            return x[:, 0]

    df = spark.createDataFrame([(i, float(i if i != 7 else -1)) for i in range(40)], "id long, x double").repartition(4)
    scored = score(df, ["id"], ["x"], Slow, "regression", "p", latency=True)
    out, seen = observed_latency(scored)
    rows = out.collect()
    total = sum(r.latency_ms for r in rows)
    assert math.isclose(seen.get["total_ms"], total, rel_tol=1e-9) and seen.get["n"] == 40 and seen.get["failed"] == sum(r.error_type is not None for r in rows) > 0
    assert total >= 4 * 45 and min(r.latency_ms for r in rows) > 0
    kept = spark.createDataFrame([(r.pipeline_id, r.latency_ms) for r in rows], "pipeline_id string, latency_ms double")
    hist = latency_histogram(kept).collect()
    assert sum(h.n for h in hist) == 40 and math.isclose(sum(h.total_ms for h in hist), total, rel_tol=1e-9)
    assert all(h.up_to_ms / 2 < h.max_ms <= h.up_to_ms for h in hist)
    assert "latency_ms" not in score(df, ["id"], ["x"], Slow, "regression", "p").columns


def test_closure_of_chains_diamonds_and_cycles(spark):
    from winnow.operators.lineage import ancestors, cycles

    edges = [(i, i + 1) for i in range(300)]  # a chain of 300
    edges += [(1000, 1001), (1001, 1002), (1002, 1000), (1010, 1000)]  # a cycle and a row that leads into it
    edges += [(2000, 2001), (2000, 2002), (2001, 2003), (2002, 2004), (2004, 2003), (2003, None), (None, 2000), (2000, 2001)]  # two ways, the shorter counts
    want = {}
    parents = {}
    for c, p in edges:
        if c is not None and p is not None:
            parents.setdefault(c, set()).add(p)
    for c in parents:
        level, d = {c}, 0
        while level:
            d += 1
            level = {p for x in level for p in parents.get(x, ())} - {a for (k, a) in want if k == c}
            want.update({(c, p): d for p in level})
    got = ancestors(spark.createDataFrame(edges, "m long, p long"), "m", "p")
    rows = got.collect()
    assert {(r.m, r.ancestor): r.depth for r in rows} == want and len(rows) == len(want)
    assert {r.m: r.length for r in cycles(got, "m").collect()} == {1000: 3, 1001: 3, 1002: 3}
    assert ancestors(spark.createDataFrame([], "m long, p long"), "m", "p").count() == 0


def test_percentiles_match_sorting(spark):
    import numpy as np
    from winnow.operators.ranking import exact_percentiles

    rows = [(g, s, i) for g, s, i in hot_rows() if g != "odd"] + [("one", 4.5, 1), ("two", 1.0, 1), ("two", 2.0, 2)]
    df = spark.createDataFrame(rows, "ds string, score double, id long").repartition(8)
    shares = {"low": 0.0, "p3": 0.03, "half": 0.5, "p90": 0.9, "top": 1.0}
    got = {r.ds: r for r in exact_percentiles(df, "ds", "score", shares).collect()}
    by = {}
    for g, s, _ in rows:
        if s is not None and not math.isnan(s):
            by.setdefault(g, []).append(s)
    assert set(got) == set(by)
    for g, own in by.items():
        for name, q in shares.items():
            assert math.isclose(got[g][name], np.percentile(own, 100 * q), rel_tol=1e-12, abs_tol=1e-12), (g, name)
    assert exact_percentiles(df.limit(0), "ds", "score", shares).count() == 0
