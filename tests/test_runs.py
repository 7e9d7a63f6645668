"""Runs on a store: stopping anywhere and going on gives the store of a run that was never stopped."""

import dataclasses
import json
import tempfile

import pytest
from pyspark.sql import functions as F

@pytest.fixture(autouse=True)
def few_partitions(spark):
    """A run is some hundred small jobs over a few rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


TABLES = ("runs", "tasks", "generations", "validation_results", "samples", "embeddings", "failures")


def tables(spark, root):
    from winnow.operators.run import stored

    return {t: sorted(map(str, stored(spark, root, t).drop("created_at").collect())) for t in TABLES}


def branch_of(spark, first, last):
    from winnow.plans.runs import llm_branch

    return llm_branch(spark, spark.range(first, last).select(F.col("id").alias("k")))


def test_stops_after_every_stage_and_publication(spark):
    from winnow.operators.run import STAGES, publish_dataset, run_branch, run_log, stored
    from winnow.plans.runs import register_models
    from winnow.sources.export import llm_records, read_current

    stopped, whole = tempfile.mkdtemp(), tempfile.mkdtemp()
    branch = branch_of(spark, 50, 84)
    for root in (stopped, whole):
        register_models(spark, root)
    ids = {run_branch(spark, stopped, branch, stop_after=s) for s in STAGES} | {run_branch(spark, stopped, branch)}
    assert ids == {run_branch(spark, whole, branch)} == {"RU000000"}
    assert tables(spark, stopped) == tables(spark, whole)
    assert [r.status for r in stored(spark, whole, "runs").orderBy("seq").collect()] == ["created", "running", "failed"]
    assert run_log(spark, whole).first()["error_message"] == "3 item(s) failed"

    # a second run over the same numbers, some of them new: what was accepted before is a duplicate now
    again = branch_of(spark, 52, 60)
    assert run_branch(spark, whole, again) == "RU000001"
    later = stored(spark, whole, "samples").filter("run_id = 'RU000001'").collect()
    assert {r.failure_code for r in later if r.status == "rejected"} >= {"duplicate_sample"} and not any(r.status == "accepted" for r in later)

    out = tempfile.mkdtemp()
    publish_dataset(spark, whole, out, branch, llm_records)
    parts = read_current(spark, out)["parts"]
    held = {name: [json.loads(r[0]) for r in spark.read.text(p).collect()] for name, p in parts.items()}
    assert all([x["sample_id"] for x in held[n]] == sorted(x["sample_id"] for x in held[n]) for n in held)
    assert sum(map(len, held.values())) == stored(spark, whole, "samples").count()
    assert {x["status"] for x in held["golden"]} == {"accepted"} and {x["status"] for x in held["rejected"]} == {"rejected"}


def test_wrong_model_and_count_end_before_any_write(spark):
    from winnow.operators.run import run_branch
    from winnow.plans.runs import register_models

    root, branch = tempfile.mkdtemp(), branch_of(spark, 1, 6)
    with pytest.raises(ValueError, match="not registered"):
        run_branch(spark, root, branch)
    register_models(spark, root)
    with pytest.raises(ValueError, match="expected 'llm'"):
        run_branch(spark, root, dataclasses.replace(branch, model_id="MO_ml"))
    assert not any(tables(spark, root).values())
    run_branch(spark, root, branch, stop_after="import")
    before = tables(spark, root)
    with pytest.raises(ValueError, match="5 items"):
        run_branch(spark, root, branch_of(spark, 1, 8))
    assert tables(spark, root) == before


def test_a_stage_that_breaks_leaves_nothing_of_itself(spark):
    from winnow.operators.run import run_branch
    from winnow.plans.runs import register_models

    root, branch = tempfile.mkdtemp(), branch_of(spark, 1, 8)
    register_models(spark, root)
    run_branch(spark, root, branch, stop_after="execute")
    before = tables(spark, root)

    def breaks(rows, accepted):
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        run_branch(spark, root, dataclasses.replace(branch, evaluate=breaks))
    assert tables(spark, root) == before
    run_branch(spark, root, branch)
    assert len(tables(spark, root)["samples"]) == 7


def test_hashed_vectors_of_texts(spark):
    """Unit vectors, equal for equal texts, alike for alike ones; null and short texts are texts too."""
    import numpy as np
    import pandas as pd
    from winnow.operators.score import hashing_embedder

    texts = pd.Series(["a plain sentence of some words", "a plain sentence of some word", "quite other letters 12345", "", None, "ab", "a plain sentence of some words"])
    v = np.array(hashing_embedder(64)(texts).tolist())
    assert v.shape == (7, 64) and (v[0] == v[6]).all() and (v[3] == v[4]).all()
    assert np.allclose(np.linalg.norm(v[[0, 1, 2, 5]], axis=1), 1, atol=1e-6)
    assert v[0] @ v[1] > 0.9 > 0.5 > abs(v[0] @ v[2])


def test_due_work_is_derived_once_per_change(spark, tmp_path, monkeypatch):
    """A resumed run asks the store what is due when it starts and after a stage has worked, not before every stage."""
    from winnow.operators import run as run_module
    from winnow.plans.runs import ml_branch, register_models

    asked = []
    due = run_module.due
    monkeypatch.setattr(run_module, "due", lambda *a: asked.append(1) or due(*a))
    root = f"{tmp_path}/store"
    register_models(spark, root)
    branch = ml_branch(spark, spark.createDataFrame([(1, 5.0, 2), (2, 5.0, 2), (3, 7.0, 13)], "k long, price double, size long"))
    run_module.run_branch(spark, root, branch, stop_after="evaluate")
    assert len(asked) == 2
    run_id = run_module.run_branch(spark, root, branch)
    assert len(asked) == 3
    got = {r.source_id: r.status for r in run_module.task_statuses(spark, root, run_id).collect()}
    assert got == {"1": "accepted", "2": "rejected", "3": "failed"}


def test_ml_evaluation_makes_its_rows_once(spark):
    from pyspark.sql import functions as F

    from winnow.operators.evaluate import evaluate_ml
    from winnow.operators.validate import RegressionSettings

    made = spark.sparkContext.accumulator(0)

    def key(i):
        made.add(1)
        return str(i % 2)

    rows = spark.range(6).select(F.col("id").cast("string").alias("sample_id"), F.lit("d").alias("dataset_id"), F.lit("p").alias("pipeline_id"),
                                 F.lit("regression").alias("mode"), F.col("id").cast("double").alias("prediction"),
                                 F.lit(None).cast("array<struct<label:string,probability:double>>").alias("probabilities"),
                                 F.udf(key, "string").asNondeterministic()("id").alias("feature"))
    out = evaluate_ml(rows, RegressionSettings(minimum=0.0, maximum=100.0), ["feature"]).collect()
    assert sum(r.status == "accepted" for r in out) == 2 and made.value == 6
