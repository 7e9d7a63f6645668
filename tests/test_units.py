"""Literal cases (FIXTURES.md) replayed as small DataFrames."""

import json
import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.functions import codes
from winnow.functions.jsonops import canonical_json, json_depth, structured_json_gate
from winnow.functions.text import bounded_text, format_id, model_identity, non_blank, render_prompt


def _one(spark, col_expr, rows, schema="t string"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col_expr.alias("x")).collect()]


def test_structured_json_gate_cases(spark):
    cases = [("", codes.EMPTY_OUTPUT), ("x" * 129, codes.TOO_LONG_OUTPUT), ("{'decision':'accept'}", codes.INVALID_JSON),
             ('{"score":NaN}', codes.INVALID_JSON), ('{"score":Infinity}', codes.INVALID_JSON), ("[1,2]", codes.WRONG_TYPE),
             ('{"a":{"b":{"c":1}}}', codes.MAX_DEPTH_EXCEEDED), ('{"b":{"x":1},"a":2}', None),
             ('{"a":1} x', codes.INVALID_JSON), ('{"a":1}}', codes.INVALID_JSON), ('{"a":1}],[{"b":2}', codes.INVALID_JSON),
             ('{"a":1},"w":2', codes.INVALID_JSON), ('{"a":1e400}', codes.NAN_DETECTED), ('{"a":1,"a":2}', None)]
    got = _one(spark, structured_json_gate(F.col("t"), 128, 3), [(c,) for c, _ in cases])
    assert got == [e for _, e in cases]


def test_depth_and_canonical(spark):
    texts = ['{"a":{"b":{"c":1}}}', "{}", '{"a":{}}', '{"a":{},"s":"}]{["}', "[1]", '{"a":[{}]}', '"x"']
    assert _one(spark, json_depth(F.col("t")), [(t,) for t in texts]) == [4, 1, 2, 2, 2, 3, 1]
    assert _one(spark, canonical_json(F.col("t")), [('{"b":{"x":1},"a":2}',), ('{"a":1,"a":2}',)]) == \
        ['{"a":2,"b":{"x":1}}', '{"a":2}']


def test_text_helpers(spark):
    df = spark.createDataFrame([(None, [("system", "Be exact"), ("user", "Return JSON")]), ("plain", None)],
                               "p string, m array<struct<role:string,content:string>>")
    got = [r[0] for r in df.select(render_prompt("p", "m")).collect()]
    assert got == ["<system>\nBe exact\n</system>\n<user>\nReturn JSON\n</user>", "plain"]
    assert _one(spark, non_blank("t"), [(" \t",), (" a ",), (None,)]) == [False, True, False]
    assert _one(spark, model_identity("t"), [(" m:latest ",), ("m:v1",)]) == ["m", "m:v1"]
    out = _one(spark, bounded_text(F.col("t"), 20), [("y" * 30,), ("short",)])
    assert len(out[0]) == 20 and out[0].endswith(codes.TRUNCATION_MARKER) and out[1] == "short"
    assert _one(spark, format_id("SAMP", F.col("n")), [(0,), (9999,), (10000,)], "n long") == ["SAMP0000", "SAMP9999", "SAMP10000"]


def test_json_schema_cases(spark):
    from winnow.operators.jsonschema import UnsupportedSchema, check_against_schema, check_schema

    schema = {"type": "object", "required": ["decision", "score"], "additionalProperties": False,
              "properties": {"decision": {"enum": ["accept", "reject"]}, "score": {"type": "number", "minimum": 0, "maximum": 1}}}
    rows = [('{"decision":"unknown","score":0.8}',), ('{"score":0.8,"decision":"accept"}',), ('{"score":2}',),
            ('{"decision":"accept","score":true,"x":1}',), ('{"decision":"accept","score":1.0}',)]
    df = spark.createDataFrame(rows, "t string").withColumn("v", F.parse_json("t"))
    out = check_against_schema(df, "v", schema).select("schema_error_count", "schema_first_path", "schema_code").collect()
    assert [tuple(r) for r in out] == [(1, "$.decision", "schema_error"), (0, None, None), (2, "$", "schema_error"),
                                       (2, "$", "schema_error"), (0, None, None)]
    with pytest.raises(UnsupportedSchema):
        check_schema({"type": "not-a-json-schema-type"})
    with pytest.raises(UnsupportedSchema):
        check_schema({"anyOf": [{"type": "string"}]})


def test_classification_and_regression(spark):
    from winnow.operators.validate import ClassificationSettings, RegressionSettings, classification_verdict, regression_verdict

    cs = ClassificationSettings(("healthy", "attention"), True, 0.6)
    P = lambda *xs: [{"label": l, "probability": p} for l, p in xs]
    rows = [("classification", "p", "healthy", P(("healthy", 0.6), ("attention", 0.4))),
            ("classification", "p", "healthy", P(("healthy", 0.59), ("attention", 0.41))),
            ("regression", "p", "healthy", None), ("classification", " ", "healthy", None),
            ("classification", "p", "unknown", None), ("classification", "p", "healthy", []),
            ("classification", "p", "healthy", P(("healthy", 0.5), ("healthy", 0.5))),
            ("classification", "p", "healthy", P(("healthy", 0.7), ("other", 0.3))),
            ("classification", "p", "healthy", P(("healthy", 0.7), ("attention", 0.4))),
            ("classification", "p", "healthy", P(("healthy", float("nan")), ("attention", float("nan")))),
            ("classification", "p", "healthy", None)]
    df = spark.createDataFrame(rows, "mode string, pipeline_id string, prediction string, "
                                     "probabilities array<struct<label:string,probability:double>>")
    got = [(r.failure_code, r.score) for r in classification_verdict(df, cs).collect()]
    assert got == [(None, 0.6), (codes.CONFIDENCE_ERROR, None), (codes.WRONG_PREDICTION_MODE, None),
                   (codes.MISSING_PIPELINE_IDENTITY, None), (codes.INVALID_CLASS, None)] + \
        [(codes.INVALID_PROBABILITY, None)] * 5 + [(codes.MISSING_PROBABILITY, None)]
    rs = RegressionSettings(-1.0, 1.0)
    rows = [(-1.0, None), (1.0, None), (2.0, None), (float("nan"), None), (float("inf"), None), (0.0, P(("a", 1.0)))]
    df = spark.createDataFrame([("regression", "p", v, pr) for v, pr in rows],
                               "mode string, pipeline_id string, prediction double, probabilities array<struct<label:string,probability:double>>")
    got = [(r.failure_code, r.score) for r in regression_verdict(df, rs).collect()]
    assert got == [(None, -1.0), (None, 1.0), (codes.RANGE_ERROR, None), (codes.NAN_DETECTED, None),
                   (codes.INFINITY_DETECTED, None), (codes.INVALID_PROBABILITY, None)]
    dfb = spark.createDataFrame([("regression", "p", True)], "mode string, pipeline_id string, prediction boolean")
    assert regression_verdict(dfb, rs).first().failure_code == codes.WRONG_TYPE


def test_feature_contract(spark):
    from winnow.functions.features import canonical_features, feature_problem, typed_features

    contract = (("latency_ms", "float"), ("error_count", "integer"), ("is_cached", "boolean"))
    ok = '{"is_cached":true,"latency_ms":12.5,"error_count":0}'
    bad = ['{"latency_ms":12.5,"error_count":null,"is_cached":true}', '{"latency_ms":12.5,"error_count":true,"is_cached":true}',
           '{"latency_ms":12.5,"error_count":0.0,"is_cached":true}', '{"latency_ms":12,"error_count":0,"is_cached":true}',
           '{"latency_ms":12.5,"error_count":0,"is_cached":1}', '{"latency_ms":12.5,"is_cached":true}',
           '{"latency_ms":12.5,"error_count":0,"is_cached":true,"x":1}', '{"latency_ms":1e400,"error_count":0,"is_cached":true}']
    got = _one(spark, feature_problem(F.col("t"), contract), [(ok,)] + [(b,) for b in bad])
    assert got[0] is None and all(g is not None for g in got[1:])
    df = spark.createDataFrame([(ok,)], "t string").select(*typed_features(F.col("t"), contract))
    assert df.select(canonical_features([n for n, _ in contract])).first()[0] == \
        '{"error_count":0,"is_cached":true,"latency_ms":12.5}'


def _greedy(vecs, t):
    unit = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    acc = []
    for i in range(len(vecs)):
        if not acc or (1 - unit[acc] @ unit[i]).min() > t:
            acc.append(i)
    return set(acc)


@pytest.mark.parametrize("tile_rows", [4096, 37])
def test_semantic_dedup_equals_loop(spark, tile_rows):
    from winnow.operators.similarity import semantic_dedup_with_evidence

    rng = np.random.default_rng(7)
    centers = rng.normal(size=(6, 8))
    vecs = np.vstack([centers[i % 6] + 0.35 * rng.normal(size=8) for i in range(150)])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, v array<float>")
    vecs32 = np.asarray([[float(np.float32(x)) for x in v] for v in vecs])
    out, rounds = semantic_dedup_with_evidence(df, [], "id", "v", 0.3, 8, tile_rows=tile_rows)
    got = {r.id for r in out.filter("status = 'accepted'").collect()}
    assert got == _greedy(vecs32, 0.3)
    if tile_rows < 150:
        assert rounds >= 1
    # evidence: duplicates name an accepted neighbour within the threshold
    for r in out.filter("status = 'rejected'").collect():
        assert r.nearest_id in got and r.distance <= 0.3 + 1e-12


def test_semantic_threshold_edges_and_fail_closed(spark):
    from winnow.operators.similarity import semantic_dedup_with_evidence

    a = [1.0, 0.0]
    b_dup = [math.cos(math.acos(1 - 0.5)), math.sin(math.acos(1 - 0.5))]  # distance 0.5 from a
    rows = [(0, a), (1, b_dup), (2, [0.0, 0.0]), (3, [1.0]), (4, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    out = {r.id: (r.status, r.failure_code) for r in semantic_dedup_with_evidence(df, [], "id", "v", 0.5, 2)[0].collect()}
    assert out[0] == (codes.ACCEPTED, None)
    assert out[1][1] == codes.DUPLICATE_SAMPLE or out[1] == (codes.ACCEPTED, None)  # 0.5 within float error
    assert out[2] == (codes.REJECTED, codes.SEMANTIC_DEDUP_ERROR)   # zero vector: NaN distance
    assert out[3] == (codes.REJECTED, codes.SEMANTIC_DEDUP_ERROR)   # wrong dimension
    assert out[4] == (codes.REJECTED, codes.SEMANTIC_DEDUP_ERROR)   # missing


def test_semantic_scope_and_prior(spark):
    from winnow.operators.similarity import semantic_dedup_with_evidence

    e0 = [1.0] + [0.0] * 7
    e1 = [0.0, 1.0] + [0.0] * 6
    prior = spark.createDataFrame([("d1", 100, e0)], "ds string, id long, v array<double>")
    cands = spark.createDataFrame([("d1", 1, e0), ("d1", 2, e1), ("d2", 3, e0)], "ds string, id long, v array<double>")
    out = {r.id: r for r in semantic_dedup_with_evidence(cands, ["ds"], "id", "v", 0.05, 8, prior_accepted=prior)[0].collect()}
    assert out[1].status == codes.REJECTED and out[1].nearest_id == 100 and abs(out[1].distance) < 1e-12
    assert out[2].status == codes.ACCEPTED and out[2].nearest_id == 100 and abs(out[2].distance - 1.0) < 1e-12
    assert out[3].status == codes.ACCEPTED and out[3].nearest_id is None


def test_exact_dedup_scope(spark):
    from winnow.operators.dedup import exact_greedy_dedup

    c = spark.createDataFrame([("a", 1, 5.0, "d1"), ("b", 1, 7.0, "d1"), ("c", 1, 7.0, "d2"), ("d", 2, 1.0, "d1")],
                              "id string, k long, pr double, ds string")
    acc = spark.createDataFrame([("z", 2, "d1")], "id string, k long, ds string")
    out = {r.id: (r.dedup_code, r.duplicate_of) for r in
           exact_greedy_dedup(c, ["k"], [-F.col("pr")], "id", ["ds"], acc, "id").collect()}
    assert out == {"b": (None, None), "a": (codes.DUPLICATE_SAMPLE, "b"), "c": (None, None), "d": (codes.DUPLICATE_SAMPLE, "z")}


def test_lifecycle(spark):
    from winnow.operators.lifecycle import (counter_violations, illegal_transitions, resume_items, run_counters,
                                            run_outcome)

    log = spark.createDataFrame([("r1", 1, "created"), ("r1", 2, "running"), ("r1", 3, "completed"), ("r1", 4, "running"),
                                 ("t1", 1, "pending"), ("t1", 2, "accepted")], "e string, seq long, status string")
    bad = {(r.e, r.from_status, r.to_status) for r in illegal_transitions(log.filter("e = 'r1'"), "e", "seq", "status", "run").collect()}
    assert bad == {("r1", "completed", "running")}
    bad = {(r.from_status, r.to_status) for r in illegal_transitions(log.filter("e = 't1'"), "e", "seq", "status", "task").collect()}
    assert bad == {("pending", "accepted")}
    tasks = spark.createDataFrame([(1, "pending"), (2, "validating"), (3, "generating"), (4, "pending")], "task_id long, status string")
    gens = spark.createDataFrame([(10, 2), (11, 2), (12, 3), (13, 4)], "generation_id long, task_id long")
    vals = spark.createDataFrame([(20, 10), (21, 12)], "validation_id long, generation_id long")
    samples = spark.createDataFrame([(30, 12)], "sample_id long, generation_id long")
    st = {r.task_id: r.resume_stage for r in resume_items(tasks, gens, vals, samples).collect()}
    assert st == {1: "execute", 2: "finalize", 3: "complete", 4: "validate"}
    t = spark.createDataFrame([("r", "accepted"), ("r", "failed"), ("r", "pending")], "run_id string, status string")
    c = run_outcome(run_counters(t)).first()
    assert (c.total_items, c.processed_items, c.accepted_items, c.failed_items, c.run_status) == (3, 2, 1, 1, "failed")
    broken = spark.createDataFrame([("r", 3, 1, 2, 0, 0)], "run_id string, total_items long, processed_items long, "
                                   "accepted_items long, rejected_items long, failed_items long")
    assert counter_violations(broken).count() == 1


def test_store_append_once_idempotent(spark):
    from winnow.sources.store import append_once, import_tasks_once, read_store

    root = tempfile.mkdtemp(prefix="winnow-store-")
    g = spark.createDataFrame([("g1", "t1", "a"), ("g2", "t1", "b"), ("g3", "t2", "c")], "generation_id string, task_id string, raw_output string")
    first = append_once(spark, g, root, "generations", order=[F.col("generation_id")])
    assert first.count() == 2
    again = append_once(spark, g, root, "generations", order=[F.col("generation_id")])
    assert again.count() == 0
    assert {r.generation_id for r in read_store(spark, root, "generations").collect()} == {"g1", "g3"}
    t1 = spark.createDataFrame([("r", " s1 ", "first", 1)], "run_id string, source_id string, input_payload string, line long")
    t2 = spark.createDataFrame([("r", "s1", "second", 1)], "run_id string, source_id string, input_payload string, line long")
    import_tasks_once(spark, t1, root, [F.col("line")])
    import_tasks_once(spark, t2, root, [F.col("line")])
    rows = read_store(spark, root, "tasks").collect()
    assert [(r.source_id, r.input_payload) for r in rows] == [("s1", "first")]


def test_task_files(spark):
    from winnow.sources.tasks import load_llm_tasks, load_ml_tasks

    d = tempfile.mkdtemp(prefix="winnow-tasks-")
    good = {"task_id": "llm_seed_001", "prompt": "Say", "expected_schema": {"type": "object", "required": ["status"]}}
    msgs = {"task_id": "llm_seed_002", "messages": [{"role": "system", "content": "x"}, {"role": "user", "content": "y"}],
            "expected_schema": {"type": "object"}}
    p = os.path.join(d, "a.jsonl")
    open(p, "w").write(json.dumps(good) + "\n" + json.dumps(msgs) + "\n")
    ok, bad = load_llm_tasks(spark, p)
    assert ok.count() == 2 and bad.count() == 0
    for content, line in [("{not-json}\n", 1), (json.dumps(good) + "\n" + json.dumps(good) + "\n", 2),
                          (json.dumps(good) + "\n\n", 2)]:
        q = os.path.join(tempfile.mkdtemp(prefix="winnow-tasks-"), "b.jsonl")
        open(q, "w").write(content)
        with pytest.raises(ValueError, match=f"line {line}"):
            load_llm_tasks(spark, q)
    both = dict(good, messages=msgs["messages"])
    q = os.path.join(tempfile.mkdtemp(prefix="winnow-tasks-"), "c.jsonl")
    open(q, "w").write(json.dumps(both) + "\n" + json.dumps(dict(good, task_id="x", expected_schema={"type": "nope"})) + "\n")
    ok, bad = load_llm_tasks(spark, q, mode="permissive")
    assert ok.count() == 0 and bad.count() == 2
    q = os.path.join(tempfile.mkdtemp(prefix="winnow-tasks-"), "m.jsonl")
    open(q, "w").write('{"task_id":"ml_seed_001","features":{"latency_ms":12.5,"error_count":0,"is_cached":true}}\n'
                       '{"task_id":"ml_seed_002","features":{"latency_ms":47,"error_count":2,"is_cached":false}}\n')
    ok, bad = load_ml_tasks(spark, q, (("latency_ms", "float"), ("error_count", "integer"), ("is_cached", "boolean")), "permissive")
    assert [r.task_id for r in ok.collect()] == ["ml_seed_001"] and [r.line for r in bad.collect()] == [2]


def test_export_publish_and_rollback(spark):
    from winnow.sources.export import json_line, publish, read_current

    root = tempfile.mkdtemp(prefix="winnow-export-")
    rows = spark.createDataFrame([("llm_b", "rejected", None), ("llm_a", "accepted", 0.5)], "sample_id string, status string, score double")
    lines = rows.select("sample_id", json_line({c: F.col(c) for c in rows.columns}).alias("line"))
    v1 = publish(spark, {"llm/golden": lines.filter("status = 'accepted'") if "status" in lines.columns else lines}, root)
    cur = read_current(spark, root)
    assert cur["version"] == v1
    text = [r.value for r in spark.read.text(cur["parts"]["llm/golden"]).collect()]
    assert text == ['{"sample_id":"llm_a","score":0.5,"status":"accepted"}', '{"sample_id":"llm_b","score":null,"status":"rejected"}']
    bad = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        publish(spark, {"llm/golden": lines}, root, violations=bad)
    assert read_current(spark, root)["version"] == v1


def test_staged_llm_evaluation(spark):
    from winnow.operators.evaluate import LLMSettings, evaluate_llm

    schema = json.dumps({"type": "object", "required": ["decision", "score"], "additionalProperties": False,
                         "properties": {"decision": {"enum": ["accept", "reject"]}, "score": {"type": "number", "minimum": 0, "maximum": 1}}})
    e = [1.0, 0.0, 0.0]
    rows = [("g1", '{"decision":"unknown","score":0.8}', schema, "d", e), ("g2", '{"score":0.8,"decision":"accept"}', schema, "d", e),
            ("g3", '{"decision":"accept","score":0.8}', schema, "d", e), ("g4", "", schema, "d", e)]
    df = spark.createDataFrame(rows, "generation_id string, raw_output string, expected_schema string, dataset_id string, emb array<double>")
    out = {r.generation_id: r for r in evaluate_llm(df, LLMSettings(128, 3, 0.05, 3), embedding_col="emb").collect()}
    assert out["g1"].failure_code == codes.SCHEMA_ERROR and [x.check_id for x in out["g1"].evidence] == ["structured_json", "json_schema"]
    assert out["g2"].status == codes.ACCEPTED and [x.check_id for x in out["g2"].evidence] == ["structured_json", "json_schema", "semantic_dedup"]
    assert out["g2"].canonical_text == '{"decision":"accept","score":0.8}'
    assert out["g3"].failure_code == codes.DUPLICATE_SAMPLE
    assert out["g4"].failure_code == codes.EMPTY_OUTPUT and len(out["g4"].evidence) == 1


def test_staged_ml_evaluation(spark):
    from winnow.operators.evaluate import evaluate_ml
    from winnow.operators.validate import RegressionSettings

    rows = [("s1", "d", 1.5, 2, "regression", "p", 0.5), ("s2", "d", 1.5, 2, "regression", "p", 0.7),
            ("s3", "d", 1.5, 2, "regression", "p", 9.0)]
    df = spark.createDataFrame(rows, "sample_id string, dataset_id string, f1 double, f2 long, mode string, pipeline_id string, prediction double")
    out = {r.sample_id: r for r in evaluate_ml(df, RegressionSettings(-1, 1), ["f1", "f2"], order=[F.col("sample_id")]).collect()}
    assert out["s1"].status == codes.ACCEPTED and len(out["s1"].evidence) == 2
    assert out["s2"].failure_code == codes.DUPLICATE_SAMPLE and out["s2"].score == 0.7 and out["s2"].duplicate_of == "s1"
    assert out["s3"].failure_code == codes.RANGE_ERROR and len(out["s3"].evidence) == 1


def test_scoring_and_ids(spark):
    from winnow.functions.text import assign_ids
    from winnow.operators.score import LinearRule, score

    df = spark.createDataFrame([(1, 1.5, 2.0, 1.0)], "id long, first double, second double, flag double")
    out = score(df, ["id"], ["first", "second", "flag"], lambda: LinearRule([100, 10, 1]), "regression", "p").first()
    assert out.prediction == 171.0 and out.used_probability_api is False
    ids = assign_ids(spark.range(0, 30).withColumnRenamed("id", "k"), "SA00", ["k"], 9990, "sid", n_parts=4)
    got = [r.sid for r in ids.orderBy("k").collect()]
    assert got[0] == "SA009990" and got[9] == "SA009999" and got[10] == "SA0010000" and len(set(got)) == 30


def test_export_helpers_and_promotion(spark):
    from winnow.functions.jsonops import promote_field
    from winnow.sources.export import first_object, first_present, relative_path_ok, same_key_set

    df = spark.createDataFrame([("", "{}", '{"a":1}', '{"b":1,"a":2}', "/abs/model.bin", '{"error_type":"E","k":1}')],
                               "a string, b string, c string, d string, p string, m string")
    v, rest = promote_field(F.col("m"), "error_type")
    # objects: an empty one is skipped; texts: only the empty string is
    assert df.select(first_present(F.col("a"), F.col("b"), F.col("c"))).first()[0] == "{}"
    r = df.select(first_object(F.col("a"), F.col("b"), F.col("c")).alias("fp"), same_key_set(F.col("c"), F.col("d")).alias("sk"),
                  relative_path_ok(F.col("p")).alias("rp"), v.alias("v"), rest.alias("rest")).first()
    assert (r.fp, r.sk, r.rp, r.v, r.rest) == ('{"a":1}', False, False, "E", '{"k":1}')


def test_skew_safe_lag_matches_window(spark):
    from pyspark.sql import Window

    from winnow.operators.lifecycle import skew_safe_lag

    rows = [("hot", i, f"s{i % 3}") for i in range(900)] + [(f"k{j}", i, f"s{i}") for j in range(20) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, o long, v string")
    got = {(r.k, r.o): r.prev for r in skew_safe_lag(df, "k", ["o"], "v", "prev", n_parts=8).collect()}
    want = {(r.k, r.o): r.prev for r in df.withColumn("prev", F.lag("v").over(Window.partitionBy("k").orderBy("o"))).collect()}
    assert got == want
