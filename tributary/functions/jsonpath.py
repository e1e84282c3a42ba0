"""Reading fields of the JSON body through VARIANT.

``field(body, "a.b.0")`` walks one path part at a time: an object key, or
(for a numeric part) an array slot.  A missing key, a slot out of range or a
walk into a scalar gives SQL NULL; a JSON ``null`` gives a VARIANT null, so
``IS NOT NULL`` is exactly "the key exists".
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_body(source="source") -> Column:
    """Body text to VARIANT; NULL for bad text, duplicate keys or no body."""
    c = F.col(source) if isinstance(source, str) else source
    return F.try_parse_json(c)


def _key_path(key: str) -> str:
    return "$['" + key.replace("\\", "\\\\").replace("'", "\\'") + "']"


def field(body: Column, path: str) -> Column:
    """VARIANT at ``path`` (dot separated), NULL when absent."""
    cur = body
    for part in path.split("."):
        by_key = F.try_variant_get(cur, _key_path(part), "variant")
        if part.isdigit():
            by_slot = F.try_variant_get(cur, f"$[{int(part)}]", "variant")
            cur = F.coalesce(by_key, by_slot)
        else:
            cur = by_key
    return cur


def kind(v: Column) -> Column:
    """Coarse JSON kind of a VARIANT: int, float, string, bool, null, array, object."""
    s = F.schema_of_variant(v)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
            .when(s.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("int"))
            .when(s.startswith("DECIMAL") | (s == "DOUBLE") | (s == "FLOAT"), F.lit("float"))
            .when(s == "STRING", F.lit("string"))
            .when(s == "BOOLEAN", F.lit("bool"))
            .when(s == "VOID", F.lit("null"))
            .when(s.startswith("ARRAY"), F.lit("array"))
            .when(s.startswith("OBJECT"), F.lit("object"))
            .otherwise(F.lit("other")))


def python_kind(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, str):
        return "string"
    if isinstance(value, (list, tuple)):
        return "array"
    if isinstance(value, dict):
        return "object"
    raise TypeError(f"not a JSON value: {value!r}")


def json_equals(v: Column, expected) -> Column:
    """Strict JSON equality of a present VARIANT with a Python JSON value.

    Numbers compare within their kind (``1`` is not ``1.0``), strings are not
    numbers.  Objects and arrays compare by canonical text (sorted keys).
    """
    k = python_kind(expected)
    vk = kind(v)
    if k == "null":
        return vk == "null"
    if k == "bool":
        return (vk == "bool") & (F.try_variant_get(v, "$", "boolean") == F.lit(expected))
    if k == "int":
        return (vk == "int") & (F.try_variant_get(v, "$", "bigint") == F.lit(expected))
    if k == "float":
        if math.isnan(expected) or math.isinf(expected):
            return F.lit(False)
        return (vk == "float") & (F.try_variant_get(v, "$", "double") == F.lit(float(expected)))
    if k == "string":
        return (vk == "string") & (F.try_variant_get(v, "$", "string") == F.lit(expected))
    canonical = json.dumps(expected, sort_keys=True, separators=(",", ":"))
    return (vk == k) & (F.to_json(v) == F.to_json(F.parse_json(F.lit(canonical))))


def as_double(v: Column) -> Column:
    """Numeric value as double, NULL when the value is not a JSON number."""
    return F.when(kind(v).isin("int", "float"), F.try_variant_get(v, "$", "double"))


def as_string(v: Column) -> Column:
    """String value, NULL when the value is not a JSON string (no casting)."""
    return F.when(kind(v) == "string", F.try_variant_get(v, "$", "string"))
