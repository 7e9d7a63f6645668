"""Incremental selection: any split and order of the batches gives the one-shot result."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

SCHEMA = "id long, k string, v int, failure_code string"


def rows():
    rng = random.Random(5)
    out = [(i, rng.choice(["hot"] * 6 + ["a", "b", "c", None]) if i % 3 else f"k{i % 40}", rng.randrange(30), "range_error" if i % 11 == 0 else None) for i in range(400)]
    return out


def one_shot(data):
    best, out = {}, {}
    for i, k, v, code in data:
        if code is None:
            best[k] = min(best.get(k, (-99, i)) if k in best else (-v, i), (-v, i))
    for i, k, v, code in data:
        dup = best[k][1] if code is None and best[k][1] != i else None
        out[i] = ("accepted" if code is None and dup is None else "rejected", code or ("duplicate_sample" if dup is not None else None), dup)
    return out


def state(spark, root):
    from winnow.streaming.incremental import current_selection

    return {r.id: (r.status, r.failure_code, r.duplicate_of) for r in current_selection(spark, root, "id", ["k"]).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_gives_the_one_shot_result(spark, seed):
    from winnow.streaming.incremental import judge_batch

    data, rng, root = rows(), random.Random(seed), tempfile.mkdtemp()
    if seed == 1:
        data.sort(key=lambda r: r[2])  # the best of each key come last: every batch corrects earlier ones
    else:
        rng.shuffle(data)
    cuts = [0, 7, 100, 260, len(data)]
    for epoch, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = data[a:b] + ([(*data[0][:2], 99, None)] if epoch else [])  # an id from before, with another value: the first write stays
        args = (spark.createDataFrame(part, SCHEMA), root, epoch, "id", ["k"], [-F.col("v")])
        judge_batch(*args, buckets=4)
        if epoch == 2:
            judge_batch(*args, buckets=4)  # a replay changes nothing
        assert state(spark, root) == one_shot(data[:b])


def test_a_stopped_batch_is_done_again(spark, monkeypatch):
    from winnow.streaming import incremental as inc

    data, root = rows(), tempfile.mkdtemp()
    args = lambda part, e: (spark.createDataFrame(part, SCHEMA), root, e, "id", ["k"], [-F.col("v")])
    inc.judge_batch(*args(data[:200], 0), buckets=2)
    plain = inc._write

    def stops(df, path, by):
        if path.endswith("verdicts"):
            raise RuntimeError("stopped")
        plain(df, path, by)

    monkeypatch.setattr(inc, "_write", stops)
    with pytest.raises(RuntimeError):
        inc.judge_batch(*args(data[200:], 1), buckets=2)  # winners and corrections are there, verdicts are not
    monkeypatch.setattr(inc, "_write", plain)
    inc.judge_batch(*args(data[200:], 1), buckets=2)
    assert state(spark, root) == one_shot(data)


def test_a_batch_reads_the_buckets_it_touches_only(spark, monkeypatch):
    from winnow.streaming import incremental as inc

    root, read = tempfile.mkdtemp(), []
    plain = inc.read_buckets
    def counted(*a):
        held = plain(*a)
        read.append((a[2], sorted(a[3]), 0 if held is None else held.count()))
        return held
    monkeypatch.setattr(inc, "read_buckets", counted)
    for e in range(4):  # ids in order: a batch touches its own range of ids, and one key
        part = [(1000 * e + i, f"k{e}", i, None) for i in range(300)]
        got = inc.judge_batch(spark.createDataFrame(part, SCHEMA), root, e, "id", ["k"], [-F.col("v")], id_bucket=F.floor(F.col("id") / 1000), buckets=64)
        assert got == {"epoch": e, "id_buckets": 1, "key_buckets": 1}
    # whatever the store holds by then, no batch reads rows of another range
    assert [n for column, _, n in read if column == "_idb"] == [0, 0, 0, 0]
    assert all(n <= 3 for column, _, n in read if column == "_kb")
    folders = [d for d in os.listdir(f"{root}/verdicts") if d.startswith("_idb")]
    assert len(folders) == 4


def test_stream_continues_after_a_stop(spark):
    from winnow.streaming.incremental import run_incremental

    data, root = rows(), tempfile.mkdtemp()
    inbox, ckpt = f"{root}/in", f"{root}/ckpt"
    schema = spark.createDataFrame([], SCHEMA).schema
    run = lambda: run_incremental(spark, inbox, schema, lambda b: b, f"{root}/store", "id", ["k"], [-F.col("v")], ckpt, buckets=4)
    for part in (data[200:], data[:200]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        assert len(run()) == 1
    assert run() == []
    assert state(spark, f"{root}/store") == one_shot(data)
