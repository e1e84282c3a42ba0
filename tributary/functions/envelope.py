"""Column functions over flat envelope columns.

Flat layout used across the engine: ``sequence, timestamp, source_id,
operation, index, doc_id, doc_type, version, source`` (``source`` is the JSON
body as text).  All functions return Columns, so they stay inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation names as they appear on the wire, the subject suffix
# of each, the subject prefix, and the metadata overhead added to event sizes.
OPERATIONS = ("index", "update", "delete", "partial_update")
WRITE_OPERATIONS = ("index", "update", "partial_update")
SUBJECT_SUFFIX = {"index": "index", "update": "update", "delete": "delete",
                  "partial_update": "partial"}
SUBJECT_PREFIX = "es"
DEFAULT_DOC_TYPE = "_doc"
METADATA_OVERHEAD_BYTES = 200


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def op_suffix(operation="operation") -> Column:
    """Subject suffix / display name (``partial_update`` shows as ``partial``)."""
    op = col(operation)
    return F.when(op == "partial_update", F.lit("partial")).otherwise(op)


def subject_index_token(index="index") -> Column:
    return F.translate(col(index), "-", "_")


def subject(tenant, index="index", operation="operation", prefix=SUBJECT_PREFIX) -> Column:
    """``{prefix}.{tenant}.{index with '-' as '_'}.{suffix}``; NULL when a part is NULL."""
    return F.concat(lit_or_col(prefix), F.lit("."), lit_or_col(tenant), F.lit("."),
                    subject_index_token(index), F.lit("."), op_suffix(operation))


def forward_subject(downstream_prefix, index="index") -> Column:
    """K4: gateway forward subject ``{prefix}.{index with '-' as '_'}``."""
    return F.concat(lit_or_col(downstream_prefix), F.lit("."), subject_index_token(index))


def requires_body(operation="operation") -> Column:
    """P5: every operation but delete carries a body."""
    return col(operation) != "delete"


def body_missing(operation="operation", source="source") -> Column:
    """Data-quality side of P5: a body is required but absent."""
    return requires_body(operation) & col(source).isNull()


def event_size(source="source", index="index", doc_id="doc_id") -> Column:
    """Bytes of the JSON body + bytes of index + bytes of doc_id (no body counts 0)."""
    return (F.coalesce(F.octet_length(col(source)), F.lit(0))
            + F.octet_length(col(index)) + F.octet_length(col(doc_id))).cast("bigint")


def envelope_size(source="source", index="index", doc_id="doc_id") -> Column:
    """P10: event size plus a fixed metadata overhead."""
    return event_size(source, index, doc_id) + F.lit(METADATA_OVERHEAD_BYTES)


def uuid_text(hex32: Column) -> Column:
    return F.concat_ws("-", F.substring(hex32, 1, 8), F.substring(hex32, 9, 4),
                       F.substring(hex32, 13, 4), F.substring(hex32, 17, 4),
                       F.substring(hex32, 21, 12))


def message_id(source_id="source_id", index="index", doc_id="doc_id", sequence="sequence") -> Column:
    """Deterministic message id, so a replay of the same change gets the same id."""
    h = F.sha2(F.concat_ws("#", col(source_id), col(index), col(doc_id),
                           col(sequence).cast("string")), 256)
    return uuid_text(h)


def with_header(headers, key: str, value) -> Column:
    """Add or replace one header (last write wins without a session setting)."""
    h = F.coalesce(col(headers), F.create_map().cast("map<string,string>"))
    kept = F.map_filter(h, lambda k, v: k != F.lit(key))
    return F.map_concat(kept, F.create_map(F.lit(key), lit_or_col(value)))


def empty_map_as_null(m) -> Column:
    """Headers are omitted on the wire when empty."""
    m = col(m)
    return F.when(F.size(m) > 0, m)


def timestamp_text(ts="timestamp") -> Column:
    """RFC 3339 text with microseconds in UTC (the engine's wire form)."""
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def make_event(operation, index, doc_id, source=None, version=None, routing=None, pipeline=None,
               doc_type=None) -> Column:
    """Event template; a delete never carries a body."""
    # a known operation name is a constant, any other string names a column
    op = F.lit(operation) if isinstance(operation, str) and operation in OPERATIONS else col(operation)
    body = F.lit(None).cast("string") if source is None else col(source)
    body = F.when(op != "delete", body)

    def opt(c, t):
        return F.lit(None).cast(t) if c is None else col(c).cast(t)
    return F.struct(op.alias("operation"), col(index).alias("index"), col(doc_id).alias("doc_id"),
                    (F.lit(DEFAULT_DOC_TYPE) if doc_type is None else col(doc_type)).alias("doc_type"),
                    opt(version, "bigint").alias("version"), opt(routing, "string").alias("routing"),
                    opt(pipeline, "string").alias("pipeline"), body.alias("source"))


def index_event(index, doc_id, source) -> Column:
    return make_event("index", index, doc_id, source)


def update_event(index, doc_id, source) -> Column:
    return make_event("update", index, doc_id, source)


def partial_update_event(index, doc_id, source) -> Column:
    return make_event("partial_update", index, doc_id, source)


def delete_event(index, doc_id) -> Column:
    return make_event("delete", index, doc_id)
