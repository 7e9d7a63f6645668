"""Cases beyond the driver's tables: schemas per row, deep lineage and cycles, hot and null
keys, id order, scoring errors, export rules, manifests."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from winnow.functions import codes


def test_schema_keys_paths_numbers_and_annotations(spark):
    from winnow.operators.jsonschema import check_against_schemas

    cases = [
        ({"properties": {"a-b": {"type": "string"}}}, {"a-b": 1}, (1, "$.a-b")),
        ({"properties": {"it's": {"type": "string"}}}, {"it's": 1}, (1, "$.it's")),
        ({"const": 100}, 1e2, (0, None)), ({"const": 1}, True, (1, "$")), ({"enum": [1.0, "x"]}, 1, (0, None)),
        ({"additionalProperties": {"type": "integer"}, "properties": {"k": {}}}, {"k": "s", "z": "s"}, (1, "$.z")),
        ({"properties": {"d": {"type": "string", "format": "date"}}}, {"d": "no date"}, (0, None)),
        ({"items": {"minimum": 3}}, [5, 1, 2], (2, "$[1]")), ({"uniqueItems": True}, [1, 1.0], (1, "$")), ({"uniqueItems": True}, [1, True], (0, None)),
        ({"type": "integer"}, 1.0, (0, None)), ({"type": "number"}, True, (1, "$")), ({"required": ["x"]}, {"x": None}, (0, None)),
        ({"pattern": "b.d"}, "abcd", (0, None)), ({"multipleOf": 0.5}, 1.25, (1, "$")), (False, 1, (1, "$")),
        ({"properties": {"a": {"type": "string"}}, "required": ["z"]}, {"a": 1}, (2, "$")),
    ]
    df = spark.createDataFrame([(i, json.dumps(d), json.dumps(s)) for i, (s, d, _) in enumerate(cases)], "id int, doc string, sch string")
    got = {r.id: (r.schema_error_count, r.schema_first_path) for r in check_against_schemas(df, "doc", "sch").collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}


def test_thousands_of_schemas(spark):
    from winnow.operators.jsonschema import check_against_schemas

    df = spark.range(5000).select("id", F.format_string('{"k":%d}', "id").alias("doc"),
                                  F.format_string('{"properties":{"k":{"maximum":%d}}}', F.col("id") - F.col("id") % 2).alias("sch"))
    got = check_against_schemas(df, "doc", "sch").groupBy((F.col("id") % 2).alias("odd")).agg(F.sum("schema_error_count").alias("n"))
    assert {r.odd: r.n for r in got.collect()} == {0: 0, 1: 2500}


def test_unsupported_schema_raises_when_a_row_uses_it(spark):
    from winnow.operators.jsonschema import check_against_schemas

    df = spark.createDataFrame([("1", '{"anyOf":[{"type":"string"}]}')], "doc string, sch string")
    with pytest.raises(Exception, match="unsupported JSON Schema keyword"):
        check_against_schemas(df, "doc", "sch").collect()


def test_lineage_of_any_depth_and_cycles(spark):
    from winnow.operators.lineage import ancestors, cycles

    chain = [(i, i + 1) for i in range(25)] + [(100, 101), (101, 102), (102, 100), (200, None)]
    got = ancestors(spark.createDataFrame(chain, "c long, p long"), "c", "p")
    rows = {(r.c, r.ancestor): r.depth for r in got.collect()}
    assert {k: d for k, d in rows.items() if k[0] < 100} == {(i, j): j - i for i in range(25) for j in range(i + 1, 26)}
    assert {(c, a) for c, a in rows if c >= 100} == {(a, b) for a in (100, 101, 102) for b in (100, 101, 102)}
    assert {(r.c, r.length) for r in cycles(got, "c").collect()} == {(100, 3), (101, 3), (102, 3)}


def test_exact_dedup_with_null_and_hot_keys(spark):
    from winnow.operators.dedup import exact_greedy_dedup

    rows = [(i, None if i % 3 == 0 else "hot" if i % 2 else f"k{i}", i % 7) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k string, pr int")
    prior = spark.createDataFrame([(1000, "k2"), (1001, None)], "id long, k string")
    got = {r.id: r.duplicate_of for r in exact_greedy_dedup(df, ["k"], [-F.col("pr")], "id").collect()}
    best = {}
    for i, k, p in sorted(rows, key=lambda r: (-r[2], r[0])):
        best.setdefault(k, i)
    assert got == {i: None if best[k] == i else best[k] for i, k, _ in rows}
    with_store = {r.id: r.duplicate_of for r in exact_greedy_dedup(df, ["k"], [-F.col("pr")], "id", accepted=prior).collect()}
    assert with_store[2] == 1000 and with_store[0] == 1001 and with_store[best["hot"]] is None


def test_id_order_crosses_a_width(spark):
    from winnow.operators.lifecycle import first_child, latest_resumable_run

    g = spark.createDataFrame([("t", "GE0010000"), ("t", "GE009999")], "task_id string, generation_id string")
    assert first_child(g, "task_id", "generation_id").first().generation_id == "GE009999"
    runs = spark.createDataFrame([("m", "RU009999", "running"), ("m", "RU0010000", "created"), ("m", "RU0010001", "failed")], "model_id string, run_id string, status string")
    assert latest_resumable_run(runs, ["model_id"]).first().run_id == "RU0010000"


@pytest.mark.parametrize("out,kind", [(float("nan"), "ValueError"), ("raise", "RuntimeError")])
def test_one_bad_prediction_fails_its_task_only(spark, out, kind):
    from winnow.operators.lifecycle import fail_tasks
    from winnow.operators.score import score

    class Odd:  # local, so that it travels to the workers by value
        def predict(self, x):
            if out == "raise":
                raise RuntimeError("no model")
            return [out if v[0] < 0 else v[0] for v in x]

    df = spark.createDataFrame([(1, 1.0), (2, -1.0)], "id long, f double").coalesce(1)
    got = {r.id: r for r in score(df, ["id"], ["f"], lambda: Odd(), "regression", "p").collect()}
    assert got[2].prediction is None and got[2].error_type == kind and got[2].error_message
    assert out == "raise" or (got[1].prediction == 1.0 and got[1].error_type is None)
    tasks = spark.createDataFrame([(1, "generating"), (2, "generating")], "task_id long, status string")
    failures = score(df, ["id"], ["f"], lambda: Odd(), "regression", "p").filter("error_type IS NOT NULL").select(
        F.col("id").alias("task_id"), F.lit(1).alias("failure_seq"), "error_type", "error_message", F.lit("").alias("error_traceback"))
    assert {r.task_id: r.status for r in fail_tasks(tasks, failures).collect()}[2] == "failed"


def test_export_rules_and_numbered_manifests(spark):
    from winnow.sources.export import consistency_violations, json_line, publish, read_current

    rows = [("ok", "accepted", None, None, True), ("reason", "accepted", None, "why", True), ("null", "accepted", None, None, None),
            ("code", "rejected", None, None, False), ("fine", "rejected", "c", "r", False)]
    df = spark.createDataFrame(rows, "sample_id string, status string, failure_code string, failure_reason string, is_valid boolean").withColumn("model_type", F.lit("llm"))
    bad = {r.sample_id: r.violation for r in consistency_violations(df, "llm").collect()}
    assert bad == {"reason": "accepted_with_failure", "null": "validity_mismatch", "code": "rejected_without_code"}
    root = tempfile.mkdtemp(prefix="winnow-export-")
    lines = df.select("sample_id", json_line({"sample_id": F.col("sample_id")}).alias("line"))
    versions = [publish(spark, {"llm/golden": lines.limit(n)}, root) for n in (1, 2, 3)]
    assert read_current(spark, root)["version"] == versions[-1]
    assert len([f for f in os.listdir(f"{root}/manifests") if f.startswith("part-")]) == 3


def test_task_lines_with_null_prompt_and_blanks_around_ids(spark):
    from winnow.sources.tasks import load_llm_tasks, load_ml_tasks

    d = tempfile.mkdtemp(prefix="winnow-tasks-")
    base = {"expected_schema": {"type": "object"}}
    lines = [{"task_id": "a", "prompt": None, "messages": [{"role": "user", "content": "x"}], **base}, {"task_id": " a ", "prompt": "p", **base},
             {"task_id": "b", "prompt": "p", "messages": None, **base}, {"task_id": "c", "prompt": None, "messages": None, **base}]
    with open(f"{d}/t.jsonl", "w") as f:
        f.write("\n".join(map(json.dumps, lines)) + "\n")
    ok, bad = load_llm_tasks(spark, f"{d}/t.jsonl", "permissive")
    assert {r.task_id for r in ok.collect()} == {"a", "b"}
    assert {r.line: r.problem for r in bad.collect()} == {2: "duplicate task_id a", 4: "exactly one of prompt or messages is required"}
    with open(f"{d}/m.jsonl", "w") as f:
        f.write('{"task_id":7,"features":{"x":1}}\n{"task_id":"7","features":{"x":1}}\n')
    ok, bad = load_ml_tasks(spark, f"{d}/m.jsonl", (("x", "integer"),), "permissive")
    assert [r.line for r in ok.collect()] == [2] and [r.line for r in bad.collect()] == [1]


def test_equal_vectors_are_at_distance_zero(spark):
    from winnow.functions.vectors import cosine_distance

    df = spark.createDataFrame([([0.1 * i, 0.3, 0.7 / (i + 1)],) for i in range(50)], "v array<double>")
    got = [r[0] for r in df.select(cosine_distance("v", "v")).collect()]
    assert min(got) >= 0.0 and max(got) < 1e-12
    assert codes.CHECK_EXACT_DEDUP == "ml_exact_dedup"


def _python_gate(text, max_characters, max_depth):
    """The contract with Python's own parser: an independent check of the column expressions."""
    import math

    if text is None or not text.strip():
        return codes.EMPTY_OUTPUT
    if len(text) > max_characters:
        return codes.TOO_LONG_OUTPUT

    def refuse(_):
        raise ValueError

    try:
        value = json.loads(text, parse_constant=refuse)
    except ValueError:
        return codes.INVALID_JSON
    if not isinstance(value, dict):
        return codes.WRONG_TYPE

    def walk(v, depth):
        kids = list(v.values()) if isinstance(v, dict) else v if isinstance(v, list) else []
        bad = isinstance(v, float) and not math.isfinite(v)
        below = [walk(k, depth + 1) for k in kids]
        return bad or any(b for b, _ in below), max([depth, *(d for _, d in below)])

    bad, depth = walk(value, 1)
    return codes.NAN_DETECTED if bad else codes.MAX_DEPTH_EXCEEDED if depth > max_depth else None


def test_json_gate_and_canonical_text_against_python(spark):
    import random

    from winnow.functions.jsonops import canonical_json, structured_json_gate

    rng = random.Random(9)

    def value(depth):
        kind = rng.randrange(9 if depth else 6)
        if kind < 6:
            return [rng.randrange(-99, 99), rng.choice([1.0, 0.5, 1e-7, 2.5e300, -0.25]), rng.choice(["a", "e+10", "x\"y\\", "é\n{[", "1e-07"]), True, None, {}][kind]
        if kind == 6:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        return {rng.choice(["b", "a", "z y", "a-b", "é"]): value(depth - 1) for _ in range(rng.randrange(4))}

    texts = [json.dumps({"k": value(4), "a": value(2)}, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1])) for _ in range(150)]
    texts += [t[:rng.randrange(len(t))] for t in texts[:40]] + [t.replace(":", "", 1) for t in texts[40:50]] + ['{"a":1e999}', '{"a":NaN}', '{"a":Infinity}', "[1]", "7", "null", '"s"',
              "{'a':1}", '{"a":1,}', '{"a":01}', '{"a":"1e999"}', '{"a":[[[[[1]]]]]}', "", "  ", " ", '{"a":"' + "x" * 600 + '"}', '{"a":1} x', '{"a":"\t"}', "{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    rows = df.select("i", "t", structured_json_gate(F.col("t"), 400, 5).alias("code"), canonical_json(F.col("t")).alias("canonical")).collect()
    wrong = [(r.t, r.code, _python_gate(r.t, 400, 5)) for r in rows if r.code != _python_gate(r.t, 400, 5)]
    assert not wrong, wrong[:5]
    for r in rows:
        if r.code is None:
            assert json.loads(r.canonical) == json.loads(r.t)
            assert "1e-07" not in r.canonical.replace('"1e-07"', "")


def test_provenance_chain_deals_lines_by_their_number(spark, tmp_path, monkeypatch):
    """Repeated suppliers, orders and lines count as often as the join makes them; a task's share of lines does not grow with them."""
    from winnow import session
    from winnow.plans.export import provenance_chain

    def table(name, schema, rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    table("region", "r_regionkey int, r_name string", [(0, "R"), (1, "S")])
    table("nation", "n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0), (1, "M", 1)])
    table("customer", "c_custkey long, c_nationkey int", [(1, 0), (2, 1), (2, 1), (3, 0)])
    table("orders", "o_orderkey long, o_custkey long", [(10, 1), (11, 1), (11, 1), (12, 2), (13, None)])
    table("supplier", "s_suppkey long", [(5,), (6,), (6,)])
    table("lineitem", "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long",
          [(10, 1, 1, 5), (10, 1, 1, 5), (10, 2, None, 6), (11, 1, 1, 6), (12, 1, 1, 5), (12, 2, 1, 7), (13, 1, 1, 5), (None, 1, 1, 5)])
    monkeypatch.setattr(session, "PARTITION_ROWS", 1)
    assert session.partitions_for(spark.range(100)) == 100
    out = {r.region: tuple(r)[1:] for r in provenance_chain(spark, str(tmp_path)).collect()}
    assert out == {"R": (8, 2, 1, 3), "S": (2, 1, 1, 1)}
