"""Committed parts: what an append reads, what a failure leaves, clashing embeddings."""

import tempfile

import pytest
from pyspark.sql import functions as F


def rows(spark, first, last):
    return spark.range(first, last).select(F.format_string("TA%07d", "id").alias("task_id"), F.col("id").alias("generation_id"))


def test_replay_appends_nothing_and_far_parts_are_not_read(spark, monkeypatch):
    from winnow.sources import store

    monkeypatch.setattr(store, "SLICE_ROWS", 50)
    root = tempfile.mkdtemp()
    for a in range(0, 4000, 1000):
        assert store.append_once(spark, rows(spark, a, a + 1000), root, "generations").count() == 1000
    assert store.append_once(spark, rows(spark, 500, 1500), root, "generations").count() == 0
    key = store.TABLE_KEYS["generations"]
    # keys beyond every part: the commit list alone rules all out
    hits, total = store.slices_to_read(spark, rows(spark, 9000, 9010), root, "generations", key)
    assert (hits, total) == ([], 80)
    # keys inside one part's range: one slice per key at most, and none for keys that were never stored
    hits, _ = store.slices_to_read(spark, rows(spark, 2000, 2003), root, "generations", key)
    assert 1 <= len(hits) <= 3
    absent = spark.range(0, 4000, 400).select(F.format_string("TA%07dx", "id").alias("task_id"), F.lit(1).alias("generation_id"))
    hits, _ = store.slices_to_read(spark, absent, root, "generations", key)
    assert len(hits) <= 1  # a filter is wrong once in some thousand times
    new = store.append_once(spark, rows(spark, 3990, 4010), root, "generations")
    assert sorted(r.generation_id for r in new.collect()) == list(range(4000, 4010))
    assert store.read_store(spark, root, "generations").agg(F.count("*"), F.countDistinct("task_id")).first()[:] == (4010, 4010)


def test_every_stored_key_is_found(spark, monkeypatch):
    from winnow.sources import store

    monkeypatch.setattr(store, "SLICE_ROWS", 64)
    root = tempfile.mkdtemp()
    df = spark.createDataFrame([("g", f"é{i}", i) if i % 5 else (None, f"{i}", i) for i in range(700)] + [("g", None, 1), (None, None, 2)],
                               "source_type string, source_id string, n int")
    key = ["source_type", "source_id"]
    assert store.append_once(spark, df, root, "embeddings").count() == 702
    assert store.append_once(spark, df.repartition(3), root, "embeddings").count() == 0
    hits, total = store.slices_to_read(spark, df, root, "embeddings", key)
    assert len(hits) == total == 11


def test_a_failed_append_leaves_nothing(spark):
    from winnow.sources import store

    root = tempfile.mkdtemp()
    store.append_once(spark, rows(spark, 0, 20), root, "generations")

    @F.udf("long")
    def breaks(i):
        raise RuntimeError("lost")

    with pytest.raises(Exception):
        store._commit_part(spark, rows(spark, 20, 40).withColumn("generation_id", breaks("generation_id")), root, "generations", ["task_id"], 1)
    assert store.read_store(spark, root, "generations").count() == 20
    assert store.append_once(spark, rows(spark, 10, 40), root, "generations").count() == 20
    # a part without its line is not there either
    real = store.commits(spark, root, "generations")
    assert len(real) == 2 and sum(c["rows"] for c in real) == 40


def test_embeddings_of_another_model_clash(spark):
    from winnow.sources import store

    root = tempfile.mkdtemp()
    schema = "embedding_id string, source_type string, source_id string, embedding_model_id string"
    first = spark.createDataFrame([("e1", "generation", "g1", "m1"), ("e2", "generation", "g2", "m1")], schema)
    assert store.append_embeddings_once(spark, first, root).count() == 2
    again = spark.createDataFrame([("e9", "generation", "g1", "m1"), ("e3", "generation", "g3", "m2")], schema)
    assert [r.embedding_id for r in store.append_embeddings_once(spark, again, root).collect()] == ["e3"]
    for model in ("m2", None):
        clash = spark.createDataFrame([("e4", "generation", "g4", "m1"), ("e5", "generation", "g2", model)], schema)
        with pytest.raises(ValueError, match="g2"):
            store.append_embeddings_once(spark, clash, root)
    assert {r.embedding_id for r in store.read_store(spark, root, "embeddings").collect()} == {"e1", "e2", "e3"}


def test_an_empty_batch_and_an_unreadable_store(spark):
    from winnow.sources import store

    root = tempfile.mkdtemp()
    assert store.read_store(spark, root, "generations") is None
    assert store.append_once(spark, rows(spark, 0, 0), root, "generations").count() == 0
    assert store.read_store(spark, root, "generations") is None
