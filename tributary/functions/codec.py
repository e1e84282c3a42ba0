"""Envelope wire codec: JSON text <-> flat columns.

Decoding parses once with ``from_json`` (PERMISSIVE, corrupt-record column)
and then applies the checks the strict decoder makes that Spark's lenient
parser does not: the seven required fields, the operation names, a
non-negative 64-bit sequence, a UUID message id and a parseable timestamp.
Rows that fail carry a ``reason`` and go to quarantine instead of being
dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.envelope import DEFAULT_DOC_TYPE, OPERATIONS, col, empty_map_as_null, timestamp_text

ENVELOPE_SCHEMA = (
    "metadata struct<msg_id:string, timestamp:string, source:string, sequence:decimal(20,0), "
    "primary_term:decimal(20,0), correlation_id:string, headers:map<string,string>>, "
    "event struct<operation:string, index:string, doc_id:string, doc_type:string, "
    "version:decimal(20,0), routing:string, pipeline:string, source:string>, "
    "_corrupt string"
)

# Fixed value: accepted message-id spellings (hyphenated, simple, braced, urn).
_HEX = "[0-9a-fA-F]"
UUID_REGEX = (rf"^(?:urn:uuid:)?(?:\{{)?{_HEX}{{8}}-?{_HEX}{{4}}-?{_HEX}{{4}}-?{_HEX}{{4}}-?{_HEX}{{12}}(?:\}})?$")
MAX_SEQUENCE = 2 ** 63 - 1

FLAT_COLUMNS = ("msg_id", "timestamp", "source_id", "sequence", "primary_term", "correlation_id",
                "headers", "operation", "index", "doc_id", "doc_type", "version", "routing",
                "pipeline", "source")

REASONS = ("malformed", "missing_field", "bad_operation", "bad_sequence", "bad_msg_id",
           "bad_timestamp", "bad_body")


def _u64_ok(c: Column) -> Column:
    return c.isNull() | ((c >= 0) & (c <= F.lit(MAX_SEQUENCE)))


def decode(df: DataFrame, payload: str = "payload", keep: tuple = (), strict_body: bool = False) -> DataFrame:
    """Payload text -> flat envelope columns plus ``reason`` (NULL when valid).

    ``strict_body=True`` also re-parses the body and rejects bodies with
    duplicate keys (costs a second JSON parse of every body).
    """
    e = F.from_json(col(payload), ENVELOPE_SCHEMA,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # exploding the one parsed value keeps filters above the parse: each payload is parsed once
    parsed = df.select(*keep, col(payload).alias("payload"), F.explode(F.array(e)).alias("_e"))
    keep = tuple(parsed.columns[:len(keep)])
    m, ev = F.col("_e.metadata"), F.col("_e.event")
    ts = m["timestamp"].try_cast("timestamp")
    seq, term, ver = m["sequence"], m["primary_term"], ev["version"]
    required = [m["msg_id"], m["timestamp"], m["source"], seq, ev["operation"], ev["index"], ev["doc_id"]]
    missing = F.lit(False)
    for r in required:
        missing = missing | r.isNull()
    reason = (F.when(F.col("_e").isNull() | F.col("_e._corrupt").isNotNull(), F.lit("malformed"))
              .when(missing, F.lit("missing_field"))
              .when(~ev["operation"].isin(list(OPERATIONS)), F.lit("bad_operation"))
              .when(~(_u64_ok(seq) & _u64_ok(term) & _u64_ok(ver)), F.lit("bad_sequence"))
              .when(~m["msg_id"].rlike(UUID_REGEX), F.lit("bad_msg_id"))
              .when(ts.isNull(), F.lit("bad_timestamp")))
    if strict_body:
        reason = reason.when(ev["source"].isNotNull() & F.try_parse_json(ev["source"]).isNull(),
                             F.lit("bad_body"))
    return parsed.select(
        *keep, "payload",
        m["msg_id"].alias("msg_id"), ts.alias("timestamp"), m["source"].alias("source_id"),
        seq.try_cast("bigint").alias("sequence"), term.try_cast("bigint").alias("primary_term"),
        m["correlation_id"].alias("correlation_id"), m["headers"].alias("headers"),
        ev["operation"].alias("operation"), ev["index"].alias("index"), ev["doc_id"].alias("doc_id"),
        F.coalesce(ev["doc_type"], F.lit(DEFAULT_DOC_TYPE)).alias("doc_type"),
        ver.try_cast("bigint").alias("version"), ev["routing"].alias("routing"),
        ev["pipeline"].alias("pipeline"), ev["source"].alias("source"),
        reason.alias("reason"))


def valid(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNull()).drop("reason", "payload")


def quarantine(decoded: DataFrame) -> DataFrame:
    """Damaged messages kept with their reason instead of being dropped."""
    return decoded.filter(F.col("reason").isNotNull()).select("payload", "reason")


def encode(msg_id="msg_id", timestamp="timestamp", source_id="source_id", sequence="sequence",
           operation="operation", index="index", doc_id="doc_id", source="source",
           doc_type=None, version=None, primary_term=None, correlation_id=None, headers=None,
           routing=None, pipeline=None) -> Column:
    """Flat columns -> envelope JSON text.

    NULL optionals and empty headers are omitted.  The body is spliced in as
    raw JSON text (never re-serialised), as the last field of ``event``.
    """
    def opt(c):
        return col(c) if c is not None else F.lit(None)
    md = F.struct(col(msg_id).alias("msg_id"), timestamp_text(timestamp).alias("timestamp"),
                  col(source_id).alias("source"), col(sequence).cast("bigint").alias("sequence"),
                  opt(primary_term).cast("bigint").alias("primary_term"),
                  opt(correlation_id).cast("string").alias("correlation_id"),
                  (empty_map_as_null(headers) if headers is not None
                   else F.lit(None).cast("map<string,string>")).alias("headers"))
    evt = F.struct(col(operation).alias("operation"), col(index).alias("index"),
                   col(doc_id).alias("doc_id"),
                   (F.coalesce(col(doc_type), F.lit(DEFAULT_DOC_TYPE)) if doc_type is not None
                    else F.lit(DEFAULT_DOC_TYPE)).alias("doc_type"),
                   opt(version).cast("bigint").alias("version"),
                   opt(routing).cast("string").alias("routing"),
                   opt(pipeline).cast("string").alias("pipeline"))
    head = F.to_json(F.struct(md.alias("metadata"), evt.alias("event")))
    body = col(source)
    # ``head`` always ends with the two braces closing ``event`` and the envelope
    without_close = head.substr(F.lit(1), F.length(head) - 2)
    return F.when(body.isNull(), head).otherwise(
        F.concat(without_close, F.lit(',"source":'), body, F.lit("}}")))
