"""Change-feed views derived from the driver tables.

``changes`` turns ``events`` into a feed of document changes; ``wire``,
``redelivered``, ``attempts`` and ``log_lines`` derive from it.  Each view has
a DataFrame form (what the engine runs) and an SQL form (what the DuckDB
oracle runs); both are narrow projections of the scan, so no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.sources.tables import read_table

FEED_COLUMNS = ("sequence", "timestamp", "operation", "index", "doc_id", "source")


def changes_from_events(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    etype = F.col("event_type")
    uid = F.col("user_id").cast("string")
    operation = (F.when(eid % 10 == 9, F.lit("delete"))
                 .when(eid % 10 == 8, F.lit("partial_update"))
                 .when(eid % 10 >= 6, F.lit("update"))
                 .otherwise(F.lit("index")))
    index = (F.when(eid % 13 == 0, F.concat(F.lit("temp_"), etype))
             .otherwise(F.concat(F.lit("app-"), etype)))
    flag = (F.when(eid % 3 == 0, F.lit(',"flag":true'))
            .when(eid % 3 == 1, F.lit(',"flag":null'))
            .otherwise(F.lit("")))
    body = F.concat(
        F.lit('{"k":'), F.regexp_extract("props", "[0-9]+", 0),
        F.lit(',"type":"'), etype,
        F.lit('","value":'), F.col("value").cast("string"),
        flag,
        F.lit(',"meta":{"uid":'), uid,
        F.lit(',"tags":["'), etype, F.lit('","t'), (eid % 4).cast("string"),
        F.lit('"]}}'))
    return events.select(
        eid.alias("sequence"),
        F.col("ts").alias("timestamp"),
        operation.alias("operation"),
        index.alias("index"),
        F.concat(F.lit("u"), uid).alias("doc_id"),
        F.when(eid % 10 == 9, F.lit(None).cast("string")).otherwise(body).alias("source"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes_from_events(read_table(spark, sf_dir, "events"))


def redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = changes(spark, sf_dir)
    return c.unionByName(c.filter(F.col("sequence") % 5 == 0))


def attempts_from_changes(c: DataFrame, with_source: bool = False) -> DataFrame:
    seq = F.col("sequence")
    status = (F.when(seq % 11 == 0, F.lit(400)).when(seq % 17 == 0, F.lit(503))
              .when(seq % 23 == 0, F.lit(409)).otherwise(F.lit(200)))
    kind = (F.when(seq % 11 == 0, F.lit("Serialization")).when(seq % 17 == 0, F.lit("Timeout"))
            .when(seq % 23 == 0, F.lit("Elasticsearch")))
    return c.select(
        "sequence", "timestamp", "index", "doc_id", "operation",
        (seq % 3 + 1).cast("int").alias("attempt"),
        status.cast("int").alias("status"),
        kind.alias("error_kind"),
        ((seq * 37) % 1000).alias("duration_ms"),
        *(["source"] if with_source else []),
    )


def attempts(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    return attempts_from_changes(changes(spark, sf_dir), with_source)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("sequence")
    tag = (F.when(seq % 7 == 0, F.lit("[ERR]")).when(seq % 7 == 1, F.lit("[WRN]"))
           .when(seq % 7 == 2, F.lit("[DBG]")).when(seq % 7 == 3, F.lit("[TRC]"))
           .when(seq % 7 == 4, F.lit("[FTL]")).when(seq % 7 == 5, F.lit("[WRN] after [ERR]"))
           .otherwise(F.lit("[INF]")))
    return changes(spark, sf_dir).select(
        "sequence", F.concat(tag, F.lit(" "), F.col("doc_id")).alias("line"))


def _uuid_text(h: Column) -> Column:
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"),
                    F.substring(h, 21, 12))


def wire_from_changes(c: DataFrame) -> DataFrame:
    """Encoded envelopes, some damaged on purpose (cut short, no doc_id, bad operation)."""
    seq = F.col("sequence")
    h = F.md5(F.concat(F.col("index"), F.lit("#"), F.col("doc_id"), F.lit("#"), seq.cast("string")))
    good = F.concat(
        F.lit('{"metadata":{"msg_id":"'), _uuid_text(h),
        F.lit('","timestamp":"2024-01-01T00:00:00Z","source":"feed-'), (seq % 3).cast("string"),
        F.lit('","sequence":'), seq.cast("string"),
        F.lit('},"event":{"operation":"'),
        F.when(seq % 103 == 0, F.lit("bogus")).otherwise(F.col("operation")),
        F.lit('","index":"'), F.col("index"), F.lit('"'),
        F.when(seq % 101 == 0, F.lit("")).otherwise(F.concat(F.lit(',"doc_id":"'), F.col("doc_id"), F.lit('"'))),
        F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit(',"source":'), F.col("source"))),
        F.lit("}}"))
    payload = F.when(seq % 97 == 0, F.lit('{"metadata":{"msg_id":')).otherwise(good)
    return c.select("sequence", payload.alias("payload"))


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire_from_changes(changes(spark, sf_dir))


# --- SQL forms for the DuckDB oracle (same rows as the DataFrame forms) ---

CHANGES_SQL = """
SELECT event_id AS sequence, ts AS timestamp,
  CASE WHEN event_id % 10 = 9 THEN 'delete'
       WHEN event_id % 10 = 8 THEN 'partial_update'
       WHEN event_id % 10 >= 6 THEN 'update' ELSE 'index' END AS operation,
  CASE WHEN event_id % 13 = 0 THEN concat('temp_', event_type)
       ELSE concat('app-', event_type) END AS index,
  concat('u', CAST(user_id AS VARCHAR(20))) AS doc_id,
  CASE WHEN event_id % 10 = 9 THEN NULL ELSE concat(
    '{"k":', regexp_extract(props, '[0-9]+', 0), ',"type":"', event_type,
    '","value":', CAST(value AS VARCHAR(30)),
    CASE WHEN event_id % 3 = 0 THEN ',"flag":true'
         WHEN event_id % 3 = 1 THEN ',"flag":null' ELSE '' END,
    ',"meta":{"uid":', CAST(user_id AS VARCHAR(20)),
    ',"tags":["', event_type, '","t', CAST(event_id % 4 AS VARCHAR(3)), '"]}}') END AS source
FROM events
"""

WIRE_SQL = """
SELECT sequence, CASE
  WHEN sequence % 97 = 0 THEN '{"metadata":{"msg_id":'
  ELSE concat('{"metadata":{"msg_id":"', substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-',
    substr(h, 17, 4), '-', substr(h, 21, 12), '","timestamp":"2024-01-01T00:00:00Z","source":"feed-',
    CAST(sequence % 3 AS VARCHAR(3)), '","sequence":', CAST(sequence AS VARCHAR(20)),
    '},"event":{"operation":"', CASE WHEN sequence % 103 = 0 THEN 'bogus' ELSE operation END,
    '","index":"', index, '"',
    CASE WHEN sequence % 101 = 0 THEN '' ELSE concat(',"doc_id":"', doc_id, '"') END,
    CASE WHEN source IS NULL THEN '' ELSE concat(',"source":', source) END, '}}') END AS payload
FROM (SELECT c.*, md5(concat(index, '#', doc_id, '#', CAST(sequence AS VARCHAR(20)))) AS h FROM changes c) x
"""

REDELIVERED_SQL = """
SELECT * FROM changes UNION ALL SELECT * FROM changes WHERE sequence % 5 = 0
"""

ATTEMPTS_SQL = """
SELECT sequence, timestamp, index, doc_id, operation, CAST(sequence % 3 + 1 AS INTEGER) AS attempt,
  CAST(CASE WHEN sequence % 11 = 0 THEN 400 WHEN sequence % 17 = 0 THEN 503
       WHEN sequence % 23 = 0 THEN 409 ELSE 200 END AS INTEGER) AS status,
  CASE WHEN sequence % 11 = 0 THEN 'Serialization' WHEN sequence % 17 = 0 THEN 'Timeout'
       WHEN sequence % 23 = 0 THEN 'Elasticsearch' END AS error_kind,
  (sequence * 37) % 1000 AS duration_ms
FROM changes
"""

LOG_LINES_SQL = """
SELECT sequence, concat(CASE WHEN sequence % 7 = 0 THEN '[ERR]' WHEN sequence % 7 = 1 THEN '[WRN]'
  WHEN sequence % 7 = 2 THEN '[DBG]' WHEN sequence % 7 = 3 THEN '[TRC]'
  WHEN sequence % 7 = 4 THEN '[FTL]' WHEN sequence % 7 = 5 THEN '[WRN] after [ERR]'
  ELSE '[INF]' END, ' ', doc_id) AS line
FROM changes
"""

_VIEW_SQL = {
    "changes": CHANGES_SQL,
    "wire": WIRE_SQL,
    "redelivered": REDELIVERED_SQL,
    "attempts": ATTEMPTS_SQL,
    "log_lines": LOG_LINES_SQL,
}
_VIEW_ORDER = ("changes", "wire", "redelivered", "attempts", "log_lines")


def with_views(sql: str, *extra_ctes: tuple[str, str]) -> str:
    """Prefix ``sql`` with the fixture views it mentions (as CTEs) plus extra CTEs."""
    used = [v for v in _VIEW_ORDER if v in sql or any(v in body for _, body in extra_ctes)]
    if any(v != "changes" for v in used) and "changes" not in used:
        used.insert(0, "changes")
    ctes = [f"{v} AS ({_VIEW_SQL[v].strip()})" for v in _VIEW_ORDER if v in used]
    ctes += [f"{name} AS ({body.strip()})" for name, body in extra_ctes]
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[len("WITH RECURSIVE"):].lstrip()
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- search responses: the store's view of ``changes`` (for S4, S5) ---

FETCH_PAGE = 1000


def hits_from_changes(c: DataFrame) -> DataFrame:
    """One hit per change, with fields missing on purpose for some sequences."""
    from tributary.sources.search import hit_json
    seq = F.col("sequence")
    return c.select(
        "sequence", (F.floor(seq / FETCH_PAGE)).cast("bigint").alias("page"),
        hit_json(seq=F.when(seq % 83 != 0, seq),
                 index=F.when(seq % 79 != 0, F.col("index")),
                 doc_id=F.when(seq % 89 != 0, F.col("doc_id")),
                 primary_term=F.when(seq % 7 != 0, seq % 5 + 1)).alias("hit"))


def responses_from_changes(c: DataFrame) -> DataFrame:
    """Search responses of at most FETCH_PAGE hits; every fourth page is an error body."""
    hits = hits_from_changes(c)
    pages = hits.groupBy("page").agg(F.concat_ws(",", F.collect_list("hit")).alias("hits"))
    body = F.when(F.col("page") % 4 == 3, F.lit('{"took":1,"error":"shard failure"}')).otherwise(
        F.concat(F.lit('{"took":1,"hits":{"hits":['), F.col("hits"), F.lit("]}}")))
    return pages.select("page", body.alias("body"))


# --- bulk responses: the store's answer to each write batch (for A13, A18, J1) ---

# Error type and reason the store reports per error kind.
STORE_ERRORS = {"Serialization": ("mapper_parsing_exception", "failed to parse"),
                "Timeout": ("timeout_exception", "timed out"),
                "Elasticsearch": ("version_conflict_engine_exception", "version conflict")}


def bulk_responses(batched_attempts: DataFrame, by=("lane", "batch_no")) -> DataFrame:
    """One response per batch; items in request order (bounded by the batch size)."""
    from tributary.sinks.bulk import response_item
    op = F.col("operation")
    action = (F.when(op == "partial_update", F.lit("update")).when(op == "delete", F.lit("delete"))
              .otherwise(F.lit("index")))
    etype, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, (t, r) in STORE_ERRORS.items():
        etype = F.when(F.col("error_kind") == kind, F.lit(t)).otherwise(etype)
        reason = F.when(F.col("error_kind") == kind, F.lit(r)).otherwise(reason)
    item = response_item(action, F.col("index"), F.col("doc_id"), F.col("status"), etype, reason)
    g = batched_attempts.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct(F.col("batch_pos").alias("p"), item.alias("i")))).alias("xs"),
        F.max("duration_ms").alias("took"), F.max(F.col("status") >= 300).alias("errors"))
    body = F.concat(F.lit('{"took":'), F.col("took").cast("string"), F.lit(',"errors":'),
                    F.col("errors").cast("string"), F.lit(',"items":['),
                    F.array_join(F.transform("xs", lambda x: x["i"]), ","), F.lit("]}"))
    return g.select(*by, body.alias("body"))
