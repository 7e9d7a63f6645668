"""Typed feature contract (B6, B7, B8) over JSON feature text.

The JSON kind of each value comes from the VARIANT; VARIANT loses
float-vs-int (``1.0`` becomes DECIMAL), so the raw number text from a
``map<string,string>`` parse decides it: a float has ``.``, ``e`` or ``E``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .jsonops import json_kind

# feature kinds and their Spark types
KIND_TYPES = {"float": "double", "integer": "bigint", "string": "string", "boolean": "boolean"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def feature_type_ok(doc: Column, raw: Column, name: str, kind: str) -> Column:
    node = F.try_variant_get(doc, f"$.{name}" if name.isidentifier() else f"$['{name}']", "variant")
    k = json_kind(node)
    text = raw[name]
    if kind == "float":
        d = F.try_variant_get(node, "$", "double")
        return k.isin("integer", "number") & text.rlike("[.eE]") & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf")))
    if kind == "integer":
        return (k == "integer") & ~text.rlike("[.eE]")
    if kind == "string":
        return k == "string"
    if kind == "boolean":
        return k == "boolean"
    raise ValueError(f"unknown feature kind {kind!r}")


def feature_problem(text, contract: Sequence[tuple[str, str]], doc: Column | None = None, raw: Column | None = None,
                    keys: Column | None = None) -> Column:
    """NULL when the feature object matches the contract, else the
    reason (key mismatch first, then the first mistyped feature in contract order).
    ``doc``/``raw``/``keys`` may be passed as already-bound columns (see
    ``with_feature_problem``) so the text is parsed once per row."""
    names = [n for n, _ in contract]
    if not names or len(set(names)) != len(names):
        raise ValueError("feature contract must contain unique ordered features")
    t = _c(text)
    doc = doc if doc is not None else F.try_parse_json(t)
    raw = raw if raw is not None else F.from_json(t, "map<string,string>")
    keys = keys if keys is not None else F.json_object_keys(t)
    expected = F.array(*[F.lit(n) for n in names])
    missing = F.array_sort(F.array_except(expected, keys))
    extra = F.array_sort(F.array_except(keys, expected))
    is_obj = json_kind(doc) == "object"
    chain = F.when(doc.isNull() | ~is_obj, F.lit("Features must be a JSON object")).when(
        (F.size(missing) > 0) | (F.size(extra) > 0),
        F.concat(F.lit("Feature keys do not match contract; missing=["), F.array_join(missing, ", "),
                 F.lit("], extra=["), F.array_join(extra, ", "), F.lit("]")))
    for n, k in contract:
        chain = chain.when(~feature_type_ok(doc, raw, n, k), F.lit(f"Feature {n} must have type {k}"))
    return chain


def typed_features(text, contract: Sequence[tuple[str, str]]) -> list[Column]:
    """The features as typed columns, in contract order."""
    doc = F.try_parse_json(_c(text))
    return [F.try_variant_get(doc, f"$.{n}", KIND_TYPES[k]).alias(n) for n, k in contract]


def canonical_features(cols: Sequence[str]) -> Column:
    """Key-sorted compact JSON of typed feature columns."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(cols)]))


def with_feature_problem(df, text_col: str, contract: Sequence[tuple[str, str]], out: str = "problem",
                         typed: bool = True):
    """B8 (+ B7 typed columns) with the text parsed once per row: the VARIANT,
    the raw value map and the key list are bound as columns first."""
    t = F.col(text_col)
    x = df.withColumns({"_fdoc": F.try_parse_json(t), "_fraw": F.from_json(t, "map<string,string>"),
                        "_fkeys": F.json_object_keys(t)})
    x = x.withColumn(out, feature_problem(t, contract, F.col("_fdoc"), F.col("_fraw"), F.col("_fkeys")))
    if typed:
        x = x.withColumns({n: F.try_variant_get(F.col("_fdoc"), f"$.{n}", KIND_TYPES[k]) for n, k in contract})
    return x.drop("_fdoc", "_fraw", "_fkeys")
