"""Strict JSON gate, depth, canonical text.

Everything is a Catalyst expression over the text column; no Python runs
per row.  The session must set ``spark.sql.variant.allowDuplicateKeys`` so
that a repeated key keeps its last value, as a strict JSON parser does.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_json_valid(text) -> Column:
    """True iff the whole text is one strict JSON value.

    ``try_parse_json`` ignores trailing text, so the value is wrapped twice;
    text that tries to break out of either wrapper fails the other one.
    """
    t = _c(text)
    return (
        F.try_parse_json(F.concat(F.lit('{"v":'), t, F.lit("}"))).isNotNull()
        & F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))).isNotNull()
    )


# VARIANT type name -> JSON kind (decimals of scale 0 are integers)
_KIND_MAP = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null",
             "BIGINT": "integer", "INT": "integer", "SMALLINT": "integer", "TINYINT": "integer", "INTDEC": "integer",
             "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number"}


def json_kind(v) -> Column:
    """JSON kind of a VARIANT: object, array, string, boolean, null, integer,
    number (NULL when absent).  ``schema_of_variant`` is evaluated once."""
    name = F.regexp_extract(F.regexp_replace(F.schema_of_variant(_c(v)), r"^DECIMAL\(\d+,0\)$", "INTDEC"), r"^[A-Z]+", 0)
    lookup = F.create_map(*[F.lit(x) for kv in _KIND_MAP.items() for x in kv])
    return F.try_element_at(lookup, name)


def json_depth(text) -> Column:
    """Maximum nesting depth of strict JSON text (root 1, each child +1,
    scalars count).  Strings and scalars collapse to ``s`` first, empty
    containers after that, then a running bracket count gives the depth."""
    t = _c(text)
    t = F.regexp_replace(t, r'"(?:[^"\\]|\\.)*"', "s")
    t = F.regexp_replace(t, r"[^\[\]{}:,\s]+", "s")
    t = F.regexp_replace(t, r"[:,\s]+", "")
    t = F.regexp_replace(t, r"\{\}|\[\]", "s")
    # keep only brackets: the running count over them is all that matters
    b = F.regexp_replace(t, r"[^\[\]{}]", "")
    steps = F.transform(F.split(b, ""), lambda ch: F.when(ch.isin("{", "["), 1).when(ch.isin("}", "]"), -1).otherwise(0))
    acc = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("cur"), F.lit(0).alias("mx")),
        lambda a, x: F.struct((a["cur"] + x).alias("cur"), F.greatest(a["mx"], a["cur"] + x).alias("mx")),
    )
    return acc["mx"] + 1


#: A JSON string, or the exponent of a number outside strings.
_EXPONENT = re.compile(r'"(?:[^"\\]|\\.)*"|e([+-]?)0*(\d+)')


def canonical_text(text: str) -> str | None:
    """One JSON text with keys sorted at every level, compact, numbers in their shortest form
    with the kind kept (``1.0`` stays a float, ``1e-7`` has no padded exponent); null if invalid."""
    try:
        out = json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)
    except ValueError:
        return None
    return _EXPONENT.sub(lambda m: m[0] if m[2] is None else f"e{m[1].replace('+', '')}{m[2]}", out)


def canonical_json(text) -> Column:
    """``canonical_text`` of a column.  VARIANT printing would turn ``1.0`` into ``1``, so the
    few calls of the JSON codec run in Arrow batches."""

    @F.pandas_udf("string")
    def canonical(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else canonical_text(t))

    return canonical(_c(text))


def has_non_finite(text) -> Column:
    """A strict JSON text holds a number that is not finite as a double.

    Strict JSON has no NaN/Infinity literals, so this is only reachable by
    overflow such as ``1e400``.  Strings are blanked first so digits inside
    them do not count."""
    no_strings = F.regexp_replace(_c(text), r'"(?:[^"\\]|\\.)*"', '""')
    nums = F.regexp_extract_all(no_strings, F.lit(r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"), 0)
    return F.exists(nums, lambda x: F.abs(x.cast("double")) == F.lit(float("inf")))


def structured_json_gate(text, max_characters: int, max_depth: int) -> Column:
    """Failure code of the strict structured-JSON contract, or NULL.

    Order: empty -> too long -> invalid -> not object -> non-finite -> depth.
    """
    t = _c(text)
    v = F.try_parse_json(t)
    return (
        F.when(t.isNull() | (F.length(F.regexp_replace(t, r"(?U)^\s+|\s+$", "")) == 0), F.lit(codes.EMPTY_OUTPUT))
        .when(F.length(t) > max_characters, F.lit(codes.TOO_LONG_OUTPUT))
        .when(~strict_json_valid(t), F.lit(codes.INVALID_JSON))
        .when(~F.schema_of_variant(v).startswith("OBJECT"), F.lit(codes.WRONG_TYPE))
        .when(has_non_finite(t), F.lit(codes.NAN_DETECTED))
        .when(json_depth(t) > max_depth, F.lit(codes.MAX_DEPTH_EXCEEDED))
    )


def promote_field(doc_text, field: str, cast: str = "string"):
    """(column value, document without the field).  The value comes from
    the VARIANT; the rest of the document is a ``map<string,variant>`` without
    the key, so every other value keeps its JSON form."""
    v = F.try_parse_json(_c(doc_text))
    value = F.try_variant_get(v, f"$.{field}", cast)
    rest = F.to_json(
        F.map_filter(F.from_json(_c(doc_text), "map<string,variant>"), lambda k, _v: k != F.lit(field))
    )
    return value, rest
