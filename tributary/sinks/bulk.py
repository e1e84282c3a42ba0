"""Bulk request encoding and bulk response parsing.

Per change: an action line, then (except for deletes) a body line.  The
lines are Column expressions; a batch body is their concatenation in batch
order, built per batch (bounded by the batch size) and written with
``write.text`` by an export job.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.envelope import col

RESPONSE_SCHEMA = ("took bigint, errors boolean, items array<map<string, struct<_index: string, _id: string, "
                   "status: int, error: struct<type: string, reason: string>>>>")


def _action(kind: str, index="index", doc_id="doc_id") -> Column:
    # keys in sorted order, as the reference serialiser writes maps
    return F.to_json(F.struct(F.struct(col(doc_id).alias("_id"), col(index).alias("_index")).alias(kind)))


def action_line(operation="operation", index="index", doc_id="doc_id") -> Column:
    """K8: ``index`` for index / update (full replace), ``update`` for partial, ``delete``."""
    op = col(operation)
    return (F.when(op.isin("index", "update"), _action("index", index, doc_id))
            .when(op == "partial_update", _action("update", index, doc_id))
            .when(op == "delete", _action("delete", index, doc_id)))


def body_line(operation="operation", source="source", doc_as_upsert: bool | None = True) -> Column:
    """K8 / K9: the document for index / update; ``{"doc":..,"doc_as_upsert":..}`` for
    partial updates; nothing for deletes or a missing body.

    ``doc_as_upsert=None`` leaves the flag out.
    """
    op, body = col(operation), col(source)
    flag = "" if doc_as_upsert is None else f',"doc_as_upsert":{"true" if doc_as_upsert else "false"}'
    partial = F.concat(F.lit('{"doc":'), body, F.lit(flag + "}"))
    return (F.when(body.isNull(), F.lit(None).cast("string"))
            .when(op.isin("index", "update"), body)
            .when(op == "partial_update", partial))


def ndjson(operation="operation", index="index", doc_id="doc_id", source="source",
           doc_as_upsert: bool | None = True) -> Column:
    """Action line + optional body line, each ending in a newline."""
    a = action_line(operation, index, doc_id)
    b = body_line(operation, source, doc_as_upsert)
    return F.concat(a, F.lit("\n"), F.coalesce(F.concat(b, F.lit("\n")), F.lit("")))


def batch_bodies(batched: DataFrame, by: Sequence[str] = ("lane", "tick", "batch_no"),
                 pos: str = "batch_pos", doc_as_upsert: bool | None = True) -> DataFrame:
    """One request body per batch, lines in batch order (bounded by the batch size)."""
    lines = batched.select(*by, F.struct(F.col(pos).alias("p"), ndjson(doc_as_upsert=doc_as_upsert).alias("l")).alias("x"))
    g = lines.groupBy(*by).agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return g.select(*by, F.array_join(F.transform("xs", lambda x: x["l"]), "").alias("body"))


def parse_response(responses: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """Bulk response -> one row per item (position, action, key, status, error).

    Any single-key item is accepted (``create`` too); ``failed`` = an error is present.
    """
    r = responses.select(*keep, F.from_json(col(body), RESPONSE_SCHEMA).alias("_r"))
    items = r.select(*keep, F.col("_r.took").alias("took"), F.col("_r.errors").alias("errors"),
                     F.posexplode(F.coalesce(F.col("_r.items"), F.array())).alias("item_no", "item"))
    res = F.map_values("item")[0]
    return items.select(*keep, "took", "errors", "item_no", F.map_keys("item")[0].alias("action"),
                        res["_index"].alias("index"), res["_id"].alias("doc_id"), res["status"].alias("status"),
                        res["error"]["type"].alias("error_type"), res["error"]["reason"].alias("error_reason"),
                        res["error"].isNotNull().alias("failed"))


def write_result(items: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per batch, success = items - failures, the failures as (doc_id, reason)."""
    failed = F.col("failed")
    fail = F.when(failed, F.struct(F.col("doc_id").alias("doc_id"), F.col("error_reason").alias("error")))
    g = items.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(failed).alias("failure_count"),
                               F.array_sort(F.collect_list(fail)).alias("failures"))
    return g.select(*by, (F.col("n") - F.col("failure_count")).alias("success_count"), "failure_count",
                    F.to_json("failures").alias("failures"),
                    (F.col("failure_count") == 0).alias("is_complete_success"),
                    (F.col("n") > F.col("failure_count")).alias("has_successes"))


def processed_totals(results: DataFrame) -> DataFrame:
    """Running totals over batch results."""
    return results.agg(F.sum("success_count").cast("bigint").alias("processed"),
                       F.sum("failure_count").cast("bigint").alias("failed"))


def response_item(action: Column, index: Column, doc_id: Column, status: Column,
                  error_type: Column, reason: Column) -> Column:
    """One response item as the store writes it (used to build test responses)."""
    err = F.when(error_type.isNotNull(), F.struct(error_type.alias("type"), reason.alias("reason")))
    res = F.struct(index.alias("_index"), doc_id.alias("_id"), status.alias("status"), err.alias("error"))
    return F.to_json(F.create_map(action, res))
