"""Envelope queries: decode / quarantine / encode (P1, P2, T6), subject and sizes
(P3-P10), body paths and renames (P11-P14), search hits (S4, S5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.fixtures import changes, responses_from_changes, hits_from_changes, wire
from tributary.functions import codec, jsonpath
from tributary.functions import envelope as env
from tributary.operators.transform import apply_transform, identity, rename_fields
from tributary.sources.search import decode_hits, explode_hits, hit_json, normalise_hits
from tributary.workloads.registry import register

_H = "md5(concat(index, '#', doc_id, '#', CAST(sequence AS VARCHAR(20))))"
_UUID = "concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12))"


@register("p1_decode_valid", f"""
SELECT sequence, {_UUID} AS msg_id, concat('feed-', CAST(sequence % 3 AS VARCHAR)) AS source_id,
  operation, index, doc_id, '_doc' AS doc_type, sequence AS version_or_seq, source
FROM (SELECT c.*, {_H} AS h FROM changes c) x
WHERE sequence % 97 <> 0 AND sequence % 101 <> 0 AND sequence % 103 <> 0""")
def p1_decode_valid(spark, sf_dir):
    d = codec.valid(codec.decode(wire(spark, sf_dir)))
    return d.select("sequence", "msg_id", "source_id", "operation", "index", "doc_id", "doc_type",
                    F.coalesce("version", "sequence").alias("version_or_seq"), "source")


@register("t6_quarantine", """
SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN sequence % 97 = 0 THEN 'malformed' WHEN sequence % 101 = 0 THEN 'missing_field'
              WHEN sequence % 103 = 0 THEN 'bad_operation' END AS reason FROM changes) t
WHERE reason IS NOT NULL GROUP BY reason""")
def t6_quarantine(spark, sf_dir):
    q = codec.quarantine(codec.decode(wire(spark, sf_dir)))
    return q.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _wrapped(spark, sf_dir):
    c = changes(spark, sf_dir)
    c = c.withColumn("source_id", F.concat(F.lit("feed-"), (F.col("sequence") % 3).cast("string")))
    return c.withColumn("msg_id", env.message_id())


_SHA_UUID = ("concat(substr(s, 1, 8), '-', substr(s, 9, 4), '-', substr(s, 13, 4), '-', "
             "substr(s, 17, 4), '-', substr(s, 21, 12))")
_SHA = ("sha256(concat_ws('#', concat('feed-', CAST(sequence % 3 AS VARCHAR)), index, doc_id, "
        "CAST(sequence AS VARCHAR)))")


@register("p2_encode_roundtrip", f"""
SELECT sequence, concat('{{"metadata":{{"msg_id":"', {_SHA_UUID}, '","timestamp":"',
  strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ'), '","source":"feed-', CAST(sequence % 3 AS VARCHAR),
  '","sequence":', CAST(sequence AS VARCHAR), '}},"event":{{"operation":"', operation, '","index":"', index,
  '","doc_id":"', doc_id, '","doc_type":"_doc","version":', CAST(sequence AS VARCHAR),
  CASE WHEN source IS NULL THEN '' ELSE concat(',"source":', source) END, '}}}}') AS payload,
  true AS roundtrip_ok
FROM (SELECT c.*, {_SHA} AS s FROM changes c) x""")
def p2_encode_roundtrip(spark, sf_dir):
    c = _wrapped(spark, sf_dir).withColumn("version", F.col("sequence"))
    enc = c.select("*", codec.encode(version="version").alias("payload"))
    dec = codec.decode(enc, keep=(F.col("sequence").alias("orig_seq"), F.col("timestamp").alias("orig_ts"),
                                  F.col("msg_id").alias("orig_id"), F.col("source_id").alias("orig_src"),
                                  F.col("operation").alias("orig_op"), F.col("index").alias("orig_index"),
                                  F.col("doc_id").alias("orig_doc"), F.col("source").alias("orig_body")))
    same = (F.col("reason").isNull()
            & F.col("sequence").eqNullSafe(F.col("orig_seq"))
            & F.col("timestamp").eqNullSafe(F.col("orig_ts").cast("timestamp"))
            & F.col("msg_id").eqNullSafe(F.col("orig_id")) & F.col("source_id").eqNullSafe(F.col("orig_src"))
            & F.col("operation").eqNullSafe(F.col("orig_op")) & F.col("index").eqNullSafe(F.col("orig_index"))
            & F.col("doc_id").eqNullSafe(F.col("orig_doc")) & F.col("source").eqNullSafe(F.col("orig_body"))
            & F.col("version").eqNullSafe(F.col("orig_seq")))
    return dec.select(F.col("orig_seq").alias("sequence"), "payload", same.alias("roundtrip_ok"))


_SUBJ_SQL = """concat('es.acme.', replace(index, '-', '_'), '.',
  CASE WHEN operation = 'partial_update' THEN 'partial' ELSE operation END)"""


@register("p3_subject", f"""
SELECT sequence, {_SUBJ_SQL} AS subject,
  concat('es.', CASE WHEN sequence % 2 = 0 THEN 'even' ELSE 'odd' END, '.', replace(index, '-', '_'), '.',
  CASE WHEN operation = 'partial_update' THEN 'partial' ELSE operation END) AS subject_by_row
FROM changes""")
def p3_subject(spark, sf_dir):
    tenant = F.when(F.col("sequence") % 2 == 0, F.lit("even")).otherwise(F.lit("odd"))
    return changes(spark, sf_dir).select("sequence", env.subject("acme").alias("subject"),
                                         env.subject(tenant).alias("subject_by_row"))


@register("p4_op_suffix", """
SELECT operation, CASE WHEN operation = 'partial_update' THEN 'partial' ELSE operation END AS suffix,
  CAST(count(*) AS BIGINT) AS n
FROM changes GROUP BY operation""")
def p4_op_suffix(spark, sf_dir):
    return (changes(spark, sf_dir).groupBy("operation", env.op_suffix().alias("suffix"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("p5_requires_body", """
SELECT sequence, operation <> 'delete' AS requires_body,
  (operation <> 'delete' AND source IS NULL) AS body_missing
FROM changes""")
def p5_requires_body(spark, sf_dir):
    return changes(spark, sf_dir).select("sequence", env.requires_body().alias("requires_body"),
                                         env.body_missing().alias("body_missing"))


@register("p6_wrap", f"""
SELECT sequence, {_SHA_UUID} AS msg_id, concat('feed-', CAST(sequence % 3 AS VARCHAR)) AS source_id,
  timestamp, index, doc_id
FROM (SELECT c.*, {_SHA} AS s FROM changes c) x""")
def p6_wrap(spark, sf_dir):
    return _wrapped(spark, sf_dir).select("sequence", "msg_id", "source_id", "timestamp", "index", "doc_id")


@register("p7_headers", """
SELECT sequence, concat('{"op":"', operation, '","index":"x"}') AS headers_json,
  doc_id AS correlation_id, CAST(1 AS BIGINT) AS primary_term, CAST(2 AS INTEGER) AS n_headers
FROM changes""")
def p7_headers(spark, sf_dir):
    c = changes(spark, sf_dir)
    h = env.with_header(F.lit(None).cast("map<string,string>"), "index", F.col("index"))
    h = env.with_header(h, "op", F.col("operation"))
    h = env.with_header(h, "index", "x")
    return c.select("sequence", F.to_json(h).alias("headers_json"),
                    F.col("doc_id").alias("correlation_id"), F.lit(1).cast("bigint").alias("primary_term"),
                    F.size(h).alias("n_headers"))


@register("p8_build_events", """
SELECT sequence, operation, index, doc_id, '_doc' AS doc_type, sequence AS version,
  CASE WHEN operation = 'delete' THEN NULL ELSE source END AS source,
  CASE WHEN operation = 'index' THEN concat('r-', doc_id) END AS routing
FROM changes""")
def p8_build_events(spark, sf_dir):
    c = changes(spark, sf_dir)
    e = env.make_event("operation", "index", "doc_id", "source", version="sequence",
                       routing=F.when(F.col("operation") == "index", F.concat(F.lit("r-"), F.col("doc_id"))))
    return c.select("sequence", e.alias("e")).select("sequence", "e.operation", "e.index", "e.doc_id",
                                                      "e.doc_type", "e.version", "e.source", "e.routing")


@register("p9_event_size", """
SELECT sequence, CAST(coalesce(strlen(source), 0) + strlen(index) + strlen(doc_id) AS BIGINT) AS event_size
FROM changes""")
def p9_event_size(spark, sf_dir):
    return changes(spark, sf_dir).select("sequence", env.event_size().alias("event_size"))


@register("p10_envelope_size", """
SELECT index, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(coalesce(strlen(source), 0) + strlen(index) + strlen(doc_id) + 200) AS BIGINT) AS envelope_bytes
FROM changes GROUP BY index""")
def p10_envelope_size(spark, sf_dir):
    return (changes(spark, sf_dir).groupBy("index")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(env.envelope_size()).cast("bigint").alias("envelope_bytes")))


def _t(path, ty):
    return f"TRY_CAST(json_extract{'_string' if ty == 'VARCHAR' else ''}(source, '$.{path}') AS {ty})"


@register("p11_field_path", f"""
SELECT sequence, {_t('k', 'BIGINT')} AS k, {_t('type', 'VARCHAR')} AS type, {_t('value', 'DOUBLE')} AS value,
  {_t('meta.uid', 'BIGINT')} AS uid, {_t('meta.tags[0]', 'VARCHAR')} AS tag0,
  {_t('meta.tags[1]', 'VARCHAR')} AS tag1, {_t('meta.tags[5]', 'VARCHAR')} AS tag5,
  {_t('type.x', 'VARCHAR')} AS into_scalar
FROM changes""")
def p11_field_path(spark, sf_dir):
    c = changes(spark, sf_dir)
    body = jsonpath.parse_body("source")
    reads = {"k": ("k", "bigint"), "type": ("type", "string"), "value": ("value", "double"),
             "uid": ("meta.uid", "bigint"), "tag0": ("meta.tags.0", "string"),
             "tag1": ("meta.tags.1", "string"), "tag5": ("meta.tags.5", "string"),
             "into_scalar": ("type.x", "string")}
    return c.select("sequence", *[F.try_variant_get(jsonpath.field(body, p), "$", t).alias(n)
                                  for n, (p, t) in reads.items()])


@register("p12_rename", f"""
SELECT sequence,
  json_extract_string(source, '$.type') AS kind,
  TRY_CAST(json_extract(source, '$.k') AS BIGINT) AS type_as_k,
  CASE WHEN source IS NULL THEN NULL ELSE false END AS has_k,
  json_extract_string(source, '$.meta.tags[0]') AS info_tag0,
  CASE WHEN source IS NULL THEN NULL ELSE json_exists(source, '$.flag') END AS has_flag,
  CASE WHEN source IS NULL THEN NULL WHEN json_exists(source, '$.flag') THEN 5 ELSE 4 END AS n_keys
FROM changes""")
def p12_rename(spark, sf_dir):
    renames = [("type", "kind"), ("k", "type"), ("meta", "info"), ("absent", "x")]
    c = apply_transform(apply_transform(changes(spark, sf_dir), identity), rename_fields(renames))
    body = jsonpath.parse_body("source")
    return c.select(
        "sequence",
        F.try_variant_get(jsonpath.field(body, "kind"), "$", "string").alias("kind"),
        F.try_variant_get(jsonpath.field(body, "type"), "$", "bigint").alias("type_as_k"),
        F.when(body.isNotNull(), jsonpath.field(body, "k").isNotNull()).alias("has_k"),
        F.try_variant_get(jsonpath.field(body, "info.tags.0"), "$", "string").alias("info_tag0"),
        F.when(body.isNotNull(), jsonpath.field(body, "flag").isNotNull()).alias("has_flag"),
        F.when(body.isNotNull(), F.size(F.map_keys(body.cast("map<string,variant>")))).alias("n_keys"))


@register("s4_normalise_hits", """
SELECT sequence, 'index' AS operation,
  CASE WHEN sequence % 79 = 0 THEN 'unknown' ELSE index END AS index,
  CASE WHEN sequence % 89 = 0 THEN 'unknown' ELSE doc_id END AS doc_id,
  CAST(CASE WHEN sequence % 7 = 0 THEN 1 ELSE sequence % 5 + 1 END AS BIGINT) AS primary_term,
  sequence AS version, coalesce(source, '{}') AS source
FROM changes WHERE sequence % 83 <> 0""")
def s4_normalise_hits(spark, sf_dir):
    return normalise_hits(hits_from_changes(changes(spark, sf_dir)))


@register("s5_explode_hits", """
SELECT page, CASE WHEN page % 4 = 3 THEN NULL ELSE CAST(count(*) AS BIGINT) END AS n_hits,
  CASE WHEN page % 4 = 3 THEN 'no_hits' END AS reason
FROM (SELECT CAST(floor(sequence / 1000) AS BIGINT) AS page FROM changes) t GROUP BY page""")
def s5_explode_hits(spark, sf_dir):
    hits = explode_hits(responses_from_changes(changes(spark, sf_dir)), keep=("page",))
    return hits.groupBy("page", "reason").agg(F.count("hit").alias("n")).select(
        "page", F.when(F.col("reason").isNull(), F.col("n")).alias("n_hits"), "reason")


@register("s4_hit_reasons", """
SELECT sequence % 41 = 0 AS planted, CASE WHEN sequence % 41 = 0 THEN 'bad_sequence' END AS reason, CAST(count(*) AS BIGINT) AS n,
  CAST(count(CASE WHEN sequence % 41 <> 0 THEN sequence END) AS BIGINT) AS n_sequences,
  min(CASE WHEN sequence % 41 = 0 THEN sequence::HUGEINT + 9223372036854775808 END)::VARCHAR AS first_seq_no
FROM changes GROUP BY 1, 2""")
def s4_hit_reasons(spark, sf_dir):
    """Hits whose sequence number needs the 64th bit are told apart, not lost."""
    seq = F.col("sequence").cast("decimal(20,0)")
    planted = F.col("sequence") % 41 == 0
    hits = changes(spark, sf_dir).select(
        "sequence", planted.alias("planted"),
        hit_json(seq=F.when(planted, seq + F.lit(str(2 ** 63)).cast("decimal(20,0)")).otherwise(seq).cast("decimal(20,0)"),
                                              primary_term=F.lit(1)).alias("hit"))
    d = decode_hits(hits, keep=("planted",))
    number = F.regexp_extract("payload", '"_seq_no":([0-9]+)', 1).cast("decimal(20,0)")
    return d.groupBy("planted", "reason").agg(F.count(F.lit(1)).alias("n"), F.count("sequence").alias("n_sequences"),
                                              F.min(number).cast("string").alias("first_seq_no"))
