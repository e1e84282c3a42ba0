"""Recursive merge of partial updates.

A partial update merges objects recursively: a field whose old and new values
are both objects is merged key by key; any other new value (scalar, array,
null, or an object replacing a non-object) replaces the old one.  Expressed on
leaves, every change assigns values at paths, and an assignment at path P
with sequence s survives when

* it is the latest assignment at P, and no later non-object assignment sits at
  a proper prefix of P (that would have replaced the whole subtree), and
* for a non-object value: no later assignment sits strictly under P (that
  would have turned P back into an object).

An empty object ``{}`` is a leaf that creates an object but never removes
what is under it; the root is such a leaf of every change.  Assignments are
pre-aggregated per path, so what meets for one document is bounded by its
distinct paths, not by its changes.  Values stay JSON text throughout: numbers
keep their spelling and characters their form.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAF_TYPE = T.ArrayType(T.StructType([
    T.StructField("parts", T.ArrayType(T.StringType())),
    T.StructField("value", T.StringType()),
    T.StructField("is_obj", T.BooleanType())]))


class _Number(str):
    """A JSON number as it was written."""


def parse(text: str):
    return json.loads(text, parse_int=_Number, parse_float=_Number, parse_constant=_Number)


def dump(value) -> str:
    """Compact JSON with sorted keys; numbers as they were written."""
    if isinstance(value, _Number):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{dump(k)}:{dump(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(dump, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def leaves_of(text) -> list[dict]:
    """Leaf assignments of one body; a body that isn't an object assigns nothing but the root."""
    out = [{"parts": [], "value": "{}", "is_obj": True}]
    try:
        doc = parse(text) if isinstance(text, str) else None
        stack = [([], doc)] if isinstance(doc, dict) else []
        while stack:
            at, obj = stack.pop()
            for k, v in obj.items():
                if isinstance(v, dict) and v:
                    stack.append(([*at, k], v))
                else:
                    out.append({"parts": [*at, k], "value": dump(v), "is_obj": isinstance(v, dict)})
    except (ValueError, RecursionError):
        return out[:1]
    return out


@F.pandas_udf(LEAF_TYPE)
def flatten_leaves(bodies: pd.Series) -> pd.Series:
    return pd.Series([leaves_of(b) for b in bodies])


def document_of(leaves) -> str:
    """JSON text of the assignments (``parts, value, is_obj, seq, leaf_seq``) that survive each other."""
    last = {tuple(x["parts"]): x for x in leaves}
    under: dict = {}
    for path, x in last.items():
        for i in range(1, len(path)):
            under[path[:i]] = max(under.get(path[:i], x["seq"]), x["seq"])
    doc: dict = {}
    for path in sorted(last, key=len):
        x = last[path]
        over = [last[path[:i]]["leaf_seq"] for i in range(1, len(path)) if path[:i] in last]
        if any(s is not None and s >= x["seq"] for s in over):
            continue
        if not path or (not x["is_obj"] and under.get(path, x["seq"] - 1) >= x["seq"]):
            continue
        at = doc
        for p in path[:-1]:
            if not isinstance(at.get(p), dict):
                at[p] = {}
            at = at[p]
        if not x["is_obj"]:
            at[path[-1]] = parse(x["value"])
        elif not isinstance(at.get(path[-1]), dict):
            at[path[-1]] = {}
    return dump(doc)


@F.pandas_udf(T.StringType())
def build_document(leaves: pd.Series) -> pd.Series:
    return pd.Series([None if ls is None or not len(ls) else document_of(
        [{**x, "leaf_seq": None if pd.isna(x["leaf_seq"]) else x["leaf_seq"]} for x in ls]) for ls in leaves], dtype=object)
