"""Task files (A1, A2): JSON Lines in, valid rows and a quarantine out.

Line numbers without a global window: rows carry (file, split start,
monotonically increasing id); per (file, split) the row count and the
smallest id are aggregated (one small row per split), a window over that
small table gives each split's first line number, and every row adds its
offset inside the split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.features import with_feature_problem
from ..functions.jsonops import json_kind, strict_json_valid
from ..functions.text import non_blank, trimmed
from ..operators.jsonschema import schema_problem

LLM_KEYS = ("task_id", "prompt", "messages", "expected_schema")
ML_KEYS = ("task_id", "features")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text) for every line, blank lines included."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_mid"), F.col("value").alias("text"))
    # the ids depend on the splits alone, which a scan of the same files cuts the same way;
    # one small row per split is all that is written
    splits = raw.groupBy("file", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file split: small
    splits = splits.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).checkpoint(eager=True)
    return raw.join(splits.select("file", "_split", "_off", "_m0"), ["file", "_split"]) \
        .select("file", (F.col("_off") + F.col("_mid") - F.col("_m0") + 1).alias("line"), "text")


def _object_keys_problem(text: Column, allowed: Sequence[str]) -> Column:
    keys = F.json_object_keys(text)
    extra = F.array_except(keys, F.array(*[F.lit(k) for k in allowed]))
    return F.when(F.size(extra) > 0, F.concat(F.lit("unknown keys: "), F.array_join(F.array_sort(extra), ", ")))


def _bound(lines: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Each line parsed once: the document, whether it is strict JSON, its kind, keys that may not be there, the id."""
    x = lines.withColumns({"_doc": F.try_parse_json("text"), "_strict": strict_json_valid("text")})
    return x.withColumns({"_kind": json_kind(F.col("_doc")), "_extra": _object_keys_problem(F.col("text"), allowed),
                          "_id": F.try_variant_get("_doc", "$.task_id", "variant")}).withColumns(
        {"_id_kind": json_kind(F.col("_id")), "task_id": trimmed(F.try_variant_get("_id", "$", "string"))})


def _record_rules() -> Column:
    """The rules that both kinds of lines share, first failure wins."""
    return (F.when(~non_blank("text"), F.lit("blank record")).when(~F.col("_strict"), F.lit("invalid JSON"))
            .when(F.col("_kind") != "object", F.lit("record must be an object")).when(F.col("_extra").isNotNull(), F.col("_extra")))


def _finish(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) of written lines with ``problem`` and ``task_id``; a repeated id is a problem of all but its first line."""
    ok = judged.filter(F.col("problem").isNull())
    # only ids that repeat are joined back, from a checkpoint, so that a hot id can be split
    firsts = ok.groupBy("task_id").agg(F.min(F.struct("file", "line")).alias("_f"), F.count(F.lit(1)).alias("_n"))
    firsts = firsts.filter("_n > 1").select(F.col("task_id").alias("_repeated"), "_f").checkpoint(eager=True)
    met = ok.join(firsts, F.col("task_id") == F.col("_repeated"), "left")
    dup = F.col("_f").isNotNull() & ((F.col("_f.file") != F.col("file")) | (F.col("_f.line") != F.col("line")))
    bad = judged.filter(F.col("problem").isNotNull()).select("file", "line", "problem").unionByName(
        met.filter(dup).select("file", "line", F.concat(F.lit("duplicate task_id "), F.col("task_id")).alias("problem")))
    return met.filter(~F.coalesce(dup, F.lit(False))).select(*[c for c in judged.columns if c != "problem"]), bad


def _fail_fast(bad: DataFrame, judged: DataFrame) -> None:
    first = bad.orderBy("file", "line").limit(1).collect()
    if first:
        raise ValueError(f"{first[0]['file']}: line {first[0]['line']}: {first[0]['problem']}")
    if judged.isEmpty():
        raise ValueError("task file is empty")


def load_llm_tasks(spark: SparkSession, path: str, mode: str = "failfast") -> tuple[DataFrame, DataFrame]:
    """A1: (valid tasks, quarantine).  ``failfast`` raises naming the first
    bad line; ``permissive`` returns both tables.  A line is parsed once and its
    verdict written; schemas are checked in the tasks that hold them, however many there are."""
    x = _bound(read_lines(spark, path), LLM_KEYS).withColumns({
        "_prompt": F.try_variant_get("_doc", "$.prompt", "variant"), "_messages": F.try_variant_get("_doc", "$.messages", "variant"),
        "_schema": F.try_variant_get("_doc", "$.expected_schema", "variant")})
    x = x.withColumns({
        # a JSON null is as good as absent
        "_has_prompt": F.coalesce(json_kind(F.col("_prompt")) != "null", F.lit(False)),
        "_has_messages": F.coalesce(json_kind(F.col("_messages")) != "null", F.lit(False)),
        "prompt": F.try_variant_get("_prompt", "$", "string"),
        "messages": F.try_variant_get("_messages", "$", "array<struct<role:string,content:string>>"),
        "expected_schema": F.to_json("_schema"), "_schema_kind": json_kind(F.col("_schema"))})
    message_keys_ok = F.forall(F.try_variant_get("_messages", "$", "array<variant>"),
                               lambda m: (json_kind(m) == "object")
                               & (F.size(F.array_except(F.json_object_keys(F.to_json(m)), F.array(F.lit("role"), F.lit("content")))) == 0))
    problem = (
        _record_rules()
        .when(F.col("_id_kind") != "string", F.lit("task_id must be a string"))
        .when(~non_blank("task_id"), F.lit("task_id must not be blank"))
        .when(F.col("_has_prompt") == F.col("_has_messages"), F.lit("exactly one of prompt or messages is required"))
        .when(F.col("_has_prompt") & ((json_kind(F.col("_prompt")) != "string") | ~non_blank("prompt")), F.lit("prompt must be a non-blank string"))
        .when(F.col("_has_messages") & (F.col("messages").isNull() | (F.size("messages") == 0)), F.lit("messages must be a non-empty list"))
        .when(F.col("_has_messages") & ~message_keys_ok, F.lit("messages have unknown keys"))
        .when(F.col("_has_messages") & ~F.forall("messages", lambda m: m["role"].isin(*codes.ROLES) & non_blank(m["content"])),
              F.lit("messages need a known role and non-blank content"))
        .when(F.col("_schema_kind") != "object", F.lit("expected_schema must be an object"))
    )
    judged = x.withColumn("problem", problem).select("file", "line", "task_id", "prompt", "messages", "expected_schema", "problem").checkpoint(eager=True)
    good, bad = _finish(judged)
    good = good.withColumn("_why", schema_problem(F.col("expected_schema"))).checkpoint(eager=True)
    bad = bad.unionByName(good.filter(F.col("_why").isNotNull()).select(
        "file", "line", F.concat(F.lit("invalid expected_schema: "), F.col("_why")).alias("problem")))
    if mode == "failfast":
        _fail_fast(bad, judged)
    return good.filter(F.col("_why").isNull()).drop("_why"), bad


def load_ml_tasks(spark: SparkSession, path: str, contract: Sequence[tuple[str, str]],
                  mode: str = "failfast") -> tuple[DataFrame, DataFrame]:
    """A2: as A1, plus the typed feature contract."""
    x = _bound(read_lines(spark, path), ML_KEYS).withColumn("features_json", F.get_json_object("text", "$.features"))
    x = with_feature_problem(x, "features_json", contract, "_features")
    problem = (
        _record_rules()
        .when((F.col("_id_kind") != "string") | ~non_blank("task_id"), F.lit("task_id must be a non-blank string"))
        .when(F.to_json(F.try_variant_get("_doc", "$.features", "variant")).isNull(), F.lit("features are required"))
        .otherwise(F.col("_features")))
    names = [n for n, _ in contract]
    judged = x.withColumn("problem", problem).select("file", "line", "task_id", *names, "features_json", "problem").checkpoint(eager=True)
    good, bad = _finish(judged)
    if mode == "failfast":
        _fail_fast(bad, judged)
    return good, bad
