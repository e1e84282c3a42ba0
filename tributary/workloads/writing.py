"""Write-side queries: batching (W1-W3, A15), bulk encode / parse (K8, K9,
A18, A13, A14), DLQ (J1, K11, W6, O3, O4), error and status classes
(P15-P20) and writer metrics (A3, A7-A12, A16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.fixtures import attempts, bulk_responses, changes, log_lines
from tributary.functions import envelope as env
from tributary.functions import errors as err
from tributary.operators import batching as bt
from tributary.operators import dlq as dq
from tributary.operators import metrics as mx
from tributary.operators.cutting import batch_lanes_by_bytes
from tributary.session import scratch_path
from tributary.sinks import bulk
from tributary.workloads.registry import register

LANES, SIZE, BUCKET = 4, 1000, 4096

_NUMBERED = """(SELECT *, CAST(sequence % 4 AS INTEGER) AS lane,
  row_number() OVER (PARTITION BY sequence % 4 ORDER BY sequence, index, doc_id) - 1 AS p FROM {src})"""
_BATCHED = f"""(SELECT *, p // 1000 AS batch_no, CAST(p % 1000 AS INTEGER) AS batch_pos FROM {_NUMBERED})"""
_SIZE_SQL = "(coalesce(strlen(source), 0) + strlen(index) + strlen(doc_id) + 200)"


def _batched(df):
    return bt.batch_by_count(df, SIZE, lane=bt.sequence_lane(LANES), bucket_width=BUCKET)


@register("w1_batch_count", f"""
SELECT sequence, lane, batch_no, batch_pos FROM {_BATCHED.format(src='changes')} b""")
def w1_batch_count(spark, sf_dir):
    return _batched(changes(spark, sf_dir)).select("sequence", "lane", "batch_no", "batch_pos")


@register("w1_batch_count_tick", """
SELECT sequence, CAST(sequence % 4 AS INTEGER) AS lane, epoch_us(timestamp) // 3600000000 AS tick,
  (row_number() OVER (PARTITION BY sequence % 4, epoch_us(timestamp) // 3600000000
                      ORDER BY sequence, index, doc_id) - 1) // 2 AS batch_no
FROM changes""")
def w1_batch_count_tick(spark, sf_dir):
    b = bt.batch_by_count(changes(spark, sf_dir), 2, lane=bt.sequence_lane(LANES), tick_ms=3_600_000)
    return b.select("sequence", "lane", "tick", "batch_no")


W2_SQL = f"""
WITH RECURSIVE s AS (
  SELECT sequence, CAST(sequence % 4 AS INTEGER) AS lane, epoch_us(timestamp) // 86400000000 AS tick, {_SIZE_SQL} AS size,
    row_number() OVER (PARTITION BY sequence % 4, epoch_us(timestamp) // 86400000000 ORDER BY sequence) AS rn
  FROM changes),
r AS (
  SELECT lane, tick, rn, sequence, CAST(0 AS BIGINT) AS batch_no, CAST(0 AS BIGINT) AS batch_pos,
         CAST(size AS BIGINT) AS acc, CAST(1 AS BIGINT) AS cnt FROM s WHERE rn = 1
  UNION ALL
  SELECT s.lane, s.tick, s.rn, s.sequence,
    CASE WHEN r.acc >= 4096 OR r.cnt >= 9 THEN r.batch_no + 1 ELSE r.batch_no END,
    CASE WHEN r.acc >= 4096 OR r.cnt >= 9 THEN 0 ELSE r.cnt END,
    CASE WHEN r.acc >= 4096 OR r.cnt >= 9 THEN s.size ELSE r.acc + s.size END,
    CASE WHEN r.acc >= 4096 OR r.cnt >= 9 THEN 1 ELSE r.cnt + 1 END
  FROM r JOIN s ON s.lane = r.lane AND s.tick = r.tick AND s.rn = r.rn + 1)
SELECT sequence, lane, tick, batch_no, CAST(batch_pos AS INTEGER) AS batch_pos FROM r"""


@register("w2_batch_bytes", W2_SQL)
def w2_batch_bytes(spark, sf_dir):
    """W2 with a flush at midnight: the groups are a lane's days."""
    b = bt.batch_by_bytes(changes(spark, sf_dir), max_bytes=4096, max_count=9,
                          lane=bt.sequence_lane(LANES), tick_ms=86_400_000)
    return b.select("sequence", "lane", "tick", "batch_no", "batch_pos")


@register("w2_parallel", f"""
WITH RECURSIVE s AS (
  SELECT sequence, {_SIZE_SQL} AS size, row_number() OVER (ORDER BY sequence, index, doc_id) AS rn FROM changes),
r AS (
  SELECT rn, sequence, CAST(0 AS BIGINT) AS batch_no, CAST(0 AS BIGINT) AS batch_pos, CAST(size AS BIGINT) AS acc FROM s WHERE rn = 1
  UNION ALL
  SELECT s.rn, s.sequence,
    CASE WHEN r.acc >= 4096 OR r.batch_pos >= 24 THEN r.batch_no + 1 ELSE r.batch_no END,
    CASE WHEN r.acc >= 4096 OR r.batch_pos >= 24 THEN 0 ELSE r.batch_pos + 1 END,
    CASE WHEN r.acc >= 4096 OR r.batch_pos >= 24 THEN s.size ELSE r.acc + s.size END
  FROM r JOIN s ON s.rn = r.rn + 1)
SELECT sequence, 0 AS lane, batch_no, CAST(batch_pos AS INTEGER) AS batch_pos FROM r""")
def w2_parallel(spark, sf_dir):
    """W2 with one lane and no tick: the whole feed is one chain of batches."""
    b = batch_lanes_by_bytes(changes(spark, sf_dir), max_bytes=4096, max_count=25, bucket_width=1 << 14)
    return b.select("sequence", "lane", "batch_no", "batch_pos")


@register("w3_batch_tick", f"""
SELECT epoch_us(timestamp) // 100000 AS tick, CAST(count(*) AS BIGINT) AS len,
  CAST(sum({_SIZE_SQL}) AS BIGINT) AS size_bytes
FROM changes GROUP BY 1""")
def w3_batch_tick(spark, sf_dir):
    t = bt.batch_by_tick(changes(spark, sf_dir), 100)
    return bt.batch_rollup(t, by=("tick",))


@register("a15_batch_rollup", f"""
SELECT lane, batch_no, CAST(count(*) AS BIGINT) AS len, CAST(sum({_SIZE_SQL}) AS BIGINT) AS size_bytes
FROM {_BATCHED.format(src='changes')} b GROUP BY lane, batch_no""")
def a15_batch_rollup(spark, sf_dir):
    return bt.batch_rollup(_batched(changes(spark, sf_dir)), by=("lane", "batch_no"))


_ACTION_SQL = """concat('{"', CASE WHEN operation IN ('index', 'update') THEN 'index'
  WHEN operation = 'partial_update' THEN 'update' ELSE 'delete' END,
  '":{"_id":"', doc_id, '","_index":"', index, '"}}')"""


@register("k8_bulk_ndjson", f"""
SELECT sequence, {_ACTION_SQL} AS action_line,
  CASE WHEN source IS NULL THEN NULL WHEN operation = 'partial_update'
       THEN concat('{{"doc":', source, ',"doc_as_upsert":true}}') ELSE source END AS body_line
FROM changes""")
def k8_bulk_ndjson(spark, sf_dir):
    return changes(spark, sf_dir).select("sequence", bulk.action_line().alias("action_line"),
                                         bulk.body_line().alias("body_line"))


@register("k9_bulk_ndjson_update", f"""
SELECT lane, batch_no, CAST(sum(strlen({_ACTION_SQL}) + 1 +
  CASE WHEN source IS NULL THEN 0 WHEN operation = 'partial_update'
       THEN strlen(source) + 31 ELSE strlen(source) + 1 END) AS BIGINT) AS body_bytes,
  CAST(count(*) AS BIGINT) AS n
FROM {_BATCHED.format(src='changes')} b GROUP BY lane, batch_no""")
def k9_bulk_ndjson_update(spark, sf_dir):
    bodies = bulk.batch_bodies(_batched(changes(spark, sf_dir)), by=("lane", "batch_no"), doc_as_upsert=False)
    lines = F.size(F.split(F.col("body"), "\n")) - 1
    return bodies.select("lane", "batch_no", F.octet_length("body").cast("bigint").alias("body_bytes"),
                         (lines - F.size(F.filter(F.split("body", "\n"), lambda s: s.startswith('{"doc"')))
                          - F.size(F.filter(F.split("body", "\n"), lambda s: s.startswith('{"k"'))))
                         .cast("bigint").alias("n"))


def _items(spark, sf_dir):
    a = _batched(attempts(spark, sf_dir, with_source=True))
    return a, bulk.parse_response(bulk_responses(a), keep=("lane", "batch_no"))


_ETYPE_SQL = """CASE error_kind WHEN 'Serialization' THEN 'mapper_parsing_exception'
  WHEN 'Timeout' THEN 'timeout_exception' WHEN 'Elasticsearch' THEN 'version_conflict_engine_exception' END"""
_REASON_SQL = """CASE error_kind WHEN 'Serialization' THEN 'failed to parse'
  WHEN 'Timeout' THEN 'timed out' WHEN 'Elasticsearch' THEN 'version conflict' END"""
_ABATCHED = _BATCHED.format(src="attempts")


@register("a18_bulk_response", f"""
SELECT lane, batch_no, CAST(batch_pos AS INTEGER) AS item_no,
  CASE WHEN operation = 'partial_update' THEN 'update' WHEN operation = 'delete' THEN 'delete' ELSE 'index' END AS action,
  index, doc_id, status, {_ETYPE_SQL} AS error_type, {_ETYPE_SQL} IS NOT NULL AS failed
FROM {_ABATCHED} b""")
def a18_bulk_response(spark, sf_dir):
    _, items = _items(spark, sf_dir)
    return items.select("lane", "batch_no", "item_no", "action", "index", "doc_id", "status", "error_type", "failed")


@register("a13_write_result", f"""
SELECT lane, batch_no, CAST(count(*) - count(error_kind) AS BIGINT) AS success_count,
  CAST(count(error_kind) AS BIGINT) AS failure_count,
  concat('[', coalesce(string_agg(CASE WHEN error_kind IS NOT NULL THEN
     concat('{{"doc_id":"', doc_id, '","error":"', {_REASON_SQL}, '"}}') END, ',' ORDER BY doc_id, {_REASON_SQL}), ''), ']') AS failures,
  count(error_kind) = 0 AS is_complete_success, count(*) > count(error_kind) AS has_successes
FROM {_ABATCHED} b GROUP BY lane, batch_no""")
def a13_write_result(spark, sf_dir):
    _, items = _items(spark, sf_dir)
    return bulk.write_result(items, by=("lane", "batch_no"))


@register("a14_processed_failed", """
SELECT CAST(count(*) - count(error_kind) AS BIGINT) AS processed, CAST(count(error_kind) AS BIGINT) AS failed
FROM attempts""")
def a14_processed_failed(spark, sf_dir):
    _, items = _items(spark, sf_dir)
    return bulk.processed_totals(bulk.write_result(items, by=("lane", "batch_no")))


def _dlq(spark, sf_dir):
    a, items = _items(spark, sf_dir)
    matched = dq.match_failures(items.filter("failed"), a, by=("lane", "batch_no"))
    return dq.dlq_entries(matched, F.col("error_reason"), F.col("error_kind"), F.col("timestamp"))


_DLQ_SQL = f"""SELECT sequence, timestamp, operation, index, doc_id, source, {_REASON_SQL} AS error,
  error_kind, timestamp AS failed_at, CAST(1 AS INTEGER) AS attempts
FROM (SELECT a.*, c.source FROM attempts a JOIN changes c USING (sequence)) x WHERE error_kind IS NOT NULL"""


@register("j1_dlq_match", f"SELECT sequence, index, doc_id, operation, error, error_kind FROM ({_DLQ_SQL}) d")
def j1_dlq_match(spark, sf_dir):
    return _dlq(spark, sf_dir).select("sequence", "index", "doc_id", "operation", "error", "error_kind")


@register("j1_dlq_match_by_key", f"""
SELECT first_seq AS sequence, index, doc_id, {_ETYPE_SQL} AS error_type FROM (
  SELECT *, min(sequence) OVER (PARTITION BY lane, batch_no, index, doc_id) AS first_seq FROM {_ABATCHED} b) t
WHERE error_kind IS NOT NULL""")
def j1_dlq_match_by_key(spark, sf_dir):
    a, items = _items(spark, sf_dir)
    m = dq.match_failures(items.filter("failed"), a, by=("lane", "batch_no"), on_position=False)
    return m.select("sequence", "index", "doc_id", "error_type")


@register("k11_dlq_append", f"""
SELECT error_kind, CAST(count(*) AS BIGINT) AS n, CAST(sum(attempts) AS BIGINT) AS attempts
FROM ({_DLQ_SQL}) d GROUP BY error_kind""")
def k11_dlq_append(spark, sf_dir):
    path = scratch_path(spark, "dlq")
    entries = _dlq(spark, sf_dir)
    dq.append(entries.filter(F.col("index").startswith("app-")), path)
    dq.append(entries.filter(~F.col("index").startswith("app-")), path)
    d = spark.read.parquet(path)
    return d.groupBy("error_kind").agg(F.count(F.lit(1)).alias("n"), F.sum("attempts").cast("bigint").alias("attempts"))


@register("w6_dlq_bound", f"""
SELECT sequence, index, doc_id, error FROM ({_DLQ_SQL}) d ORDER BY failed_at DESC, sequence DESC LIMIT 100""")
def w6_dlq_bound(spark, sf_dir):
    return dq.bound(_dlq(spark, sf_dir), 100).select("sequence", "index", "doc_id", "error")


@register("o3_dlq_peek", f"""
SELECT sequence, index, doc_id, error FROM ({_DLQ_SQL}) d ORDER BY failed_at, sequence LIMIT 10""")
def o3_dlq_peek(spark, sf_dir):
    return dq.peek(_dlq(spark, sf_dir), 10).select("sequence", "index", "doc_id", "error")


@register("o4_dlq_replay", f"""
SELECT sequence, error_kind, attempts + 1 AS attempts, false AS replayed FROM ({_DLQ_SQL}) d
WHERE error_kind NOT IN ('Backpressure', 'Timeout', 'ResourceExhausted')
UNION ALL
SELECT sequence, NULL, NULL, true FROM ({_DLQ_SQL}) d
WHERE error_kind IN ('Backpressure', 'Timeout', 'ResourceExhausted')""")
def o4_dlq_replay(spark, sf_dir):
    retried, again = dq.replay(_dlq(spark, sf_dir))
    a = again.select("sequence", "error_kind", "attempts", F.lit(False).alias("replayed"))
    r = retried.select("sequence", F.lit(None).cast("string").alias("error_kind"),
                       F.lit(None).cast("int").alias("attempts"), F.lit(True).alias("replayed"))
    return a.unionByName(r)


# ------------------------------------------------------------ classes and schedules

@register("p15_error_class", """
SELECT sequence, error_kind, error_kind IN ('Elasticsearch', 'Nats', 'Backpressure', 'Timeout') AS retryable,
  error_kind IN ('Backpressure', 'Timeout', 'ResourceExhausted') AS transient
FROM attempts WHERE error_kind IS NOT NULL""")
def p15_error_class(spark, sf_dir):
    a = attempts(spark, sf_dir).filter(F.col("error_kind").isNotNull())
    return a.select("sequence", "error_kind", err.is_retryable().alias("retryable"),
                    err.is_transient().alias("transient"))


@register("p16_item_status", """
SELECT status, status >= 200 AND status < 300 AS success, CAST(count(*) AS BIGINT) AS n FROM attempts GROUP BY status""")
def p16_item_status(spark, sf_dir):
    return attempts(spark, sf_dir).groupBy("status", err.item_success().alias("success")).agg(
        F.count(F.lit(1)).alias("n"))


@register("p17_request_class", """
SELECT sequence, CASE WHEN status BETWEEN 200 AND 299 THEN 'success'
  WHEN status BETWEEN 500 AND 599 AND attempt < 3 THEN 'retry' ELSE 'fail' END AS request_class
FROM attempts""")
def p17_request_class(spark, sf_dir):
    return attempts(spark, sf_dir).select("sequence", err.request_class().alias("request_class"))


@register("p18_backoff", """
SELECT sequence, attempt, CAST(least(floor(100.0 * pow(2.0, attempt - 1)), 10000) AS BIGINT) AS delay_ms,
  attempt < 3 AS should_retry,
  timestamp + to_milliseconds(CAST(least(floor(100.0 * pow(2.0, attempt - 1)), 10000) AS BIGINT)) AS next_attempt_at
FROM attempts WHERE status NOT BETWEEN 200 AND 299""")
def p18_backoff(spark, sf_dir):
    a = attempts(spark, sf_dir).filter(~err.item_success())
    d = err.backoff_ms()
    return a.select("sequence", "attempt", d.alias("delay_ms"), err.should_retry().alias("should_retry"),
                    F.timestamp_add("MILLISECOND", d, F.col("timestamp")).alias("next_attempt_at"))


@register("p19_error_context", """
SELECT sequence, concat('[writer::bulk] doc=', doc_id, ' index=', index, ' seq=', CAST(sequence AS VARCHAR)) AS context,
  concat('[writer::', operation, ']') AS short_context
FROM attempts WHERE error_kind IS NOT NULL""")
def p19_error_context(spark, sf_dir):
    a = attempts(spark, sf_dir).filter(F.col("error_kind").isNotNull())
    return a.select("sequence", err.error_context("writer", "bulk", "doc_id", "index", "sequence").alias("context"),
                    err.error_context("writer", F.col("operation")).alias("short_context"))


@register("p20_log_level", """
SELECT CASE WHEN contains(line, '[ERR]') OR contains(line, '[FTL]') THEN 'error'
  WHEN contains(line, '[WRN]') THEN 'warn' WHEN contains(line, '[DBG]') OR contains(line, '[TRC]') THEN 'debug'
  ELSE 'info' END AS level, CAST(count(*) AS BIGINT) AS n
FROM log_lines GROUP BY 1""")
def p20_log_level(spark, sf_dir):
    return log_lines(spark, sf_dir).groupBy(err.log_level().alias("level")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ writer metrics

@register("a2_changes_total", """
SELECT 'watcher' AS component, index, operation, CAST(count(*) AS BIGINT) AS changes
FROM changes GROUP BY index, operation""")
def a2_changes_total(spark, sf_dir):
    return mx.changes_total(changes(spark, sf_dir), "watcher")


@register("a3_errors_total", """
SELECT 'writer' AS component, error_kind AS error_type, CAST(count(*) AS BIGINT) AS errors
FROM attempts WHERE error_kind IS NOT NULL GROUP BY error_kind""")
def a3_errors_total(spark, sf_dir):
    return mx.errors_total(attempts(spark, sf_dir), "writer")


def _quantile_sql(q: float) -> str:
    """A quantile interpolated within its bucket, over columns ``le_0 ...`` and ``n``."""
    cases = []
    for i, high in enumerate(mx.LATENCY_BUCKETS):
        low, below = (mx.LATENCY_BUCKETS[i - 1], f"le_{i - 1}") if i else (0.0, "0")
        cases.append(f"WHEN le_{i} >= n * {q}::DOUBLE THEN {low}::DOUBLE + ({high}::DOUBLE - {low}::DOUBLE) "
                     f"* (n * {q}::DOUBLE - {below}) / (le_{i} - {below})")
    return f"round(CASE {' '.join(cases)} ELSE {mx.LATENCY_BUCKETS[-1]}::DOUBLE END, 6)"


_LE_SQL = ", ".join(f"count(*) FILTER (WHERE duration_ms / 1000.0 <= {b}) AS le_{i}" for i, b in enumerate(mx.LATENCY_BUCKETS))
_LE_ROWS = ", ".join(f"({b}::DOUBLE, {i})" for i, b in enumerate(mx.LATENCY_BUCKETS))
_LE_PICK = "CASE i " + " ".join(f"WHEN {i} THEN le_{i}" for i in range(len(mx.LATENCY_BUCKETS))) + " END"


@register("a7_latency_buckets", f"""
SELECT index, CAST(n AS BIGINT) AS count, round(total, 6) AS sum, {_quantile_sql(0.5)} AS p50, {_quantile_sql(0.99)} AS p99,
  le, CAST({_LE_PICK} AS BIGINT) AS bucket_count
FROM (SELECT index, count(*) AS n, sum(duration_ms / 1000.0) AS total, {_LE_SQL} FROM attempts GROUP BY index) w,
     (VALUES {_LE_ROWS}) b(le, i)""")
def a7_latency_buckets(spark, sf_dir):
    h = mx.latency_histogram(attempts(spark, sf_dir), F.col("duration_ms") / 1000.0, by=("index",))
    return h.select("index", "count", F.round("sum", 6).alias("sum"), F.round("p50", 6).alias("p50"),
                    F.round("p99", 6).alias("p99"), "le", "bucket_count")


@register("a7_sketch_rollup", """
SELECT date_trunc('day', timestamp) AS window_start, index, CAST(count(*) AS BIGINT) AS count,
  true AS p50_within, true AS p90_within, true AS p99_within
FROM attempts GROUP BY 1, 2""")
def a7_sketch_rollup(spark, sf_dir):
    """Minute sketches kept as a table, rolled up to hours and days; each quantile's rank against the rows themselves."""
    a, tops = attempts(spark, sf_dir), (0.5, 0.9, 0.99)
    minutes = scratch_path(spark, "sketches/minutes")
    mx.latency_sketches(a, F.col("duration_ms"), by=("index",)).write.parquet(minutes)
    days = mx.roll_up(mx.roll_up(spark.read.parquet(minutes), "hour", ("index",)), "day", ("index",))
    found = mx.sketch_quantiles(days, tops)
    rows = a.select(F.date_trunc("day", "timestamp").cast("timestamp_ntz").alias("window_start"), "index", "duration_ms")
    met = rows.join(found, ["window_start", "index"])
    within = []
    for q in tops:
        p = f"p{round(q * 100)}"
        below, upto = F.count_if(F.col("duration_ms") < F.col(p)), F.count_if(F.col("duration_ms") <= F.col(p))
        n = F.count(F.lit(1))
        within.append(((below / n <= q + mx.RANK_ERROR) & (upto / n >= q - mx.RANK_ERROR)).alias(f"{p}_within"))
    return met.groupBy("window_start", "index").agg(F.max("count").alias("count"), *within)


@register("a8_docs_indexed_failed", """
SELECT 'writer' AS component, index, CAST(count_if(status BETWEEN 200 AND 299) AS BIGINT) AS docs_indexed,
  CAST(count_if(status NOT BETWEEN 200 AND 299) AS BIGINT) AS docs_failed
FROM attempts GROUP BY index""")
def a8_docs_indexed_failed(spark, sf_dir):
    return mx.docs_indexed_failed(attempts(spark, sf_dir), "writer")


@register("a9_bulk_requests", "SELECT status, CAST(count(*) AS BIGINT) AS requests FROM attempts GROUP BY status")
def a9_bulk_requests(spark, sf_dir):
    return mx.bulk_requests_by_status(attempts(spark, sf_dir))


@register("a10_retry_total", "SELECT CAST(sum(greatest(attempt - 1, 0)) AS BIGINT) AS retries FROM attempts")
def a10_retry_total(spark, sf_dir):
    return mx.retry_total(attempts(spark, sf_dir))


@register("a11_gauges", """
SELECT s.index, s.source_max, c.committed_max, s.source_max - coalesce(c.committed_max, -1) AS lag,
  CAST(d.dlq_size AS BIGINT) AS dlq_size, d.last_duration_ms
FROM (SELECT index, max(sequence) AS source_max FROM changes GROUP BY index) s
LEFT JOIN (SELECT index, max(sequence) AS committed_max FROM attempts WHERE status BETWEEN 200 AND 299
           AND sequence < (SELECT max(sequence) * 3 // 4 FROM changes) GROUP BY index) c USING (index)
LEFT JOIN (SELECT index, count_if(status NOT BETWEEN 200 AND 299) AS dlq_size,
           arg_max(duration_ms, sequence) AS last_duration_ms FROM attempts GROUP BY index) d USING (index)""")
def a11_gauges(spark, sf_dir):
    c = changes(spark, sf_dir)
    a = attempts(spark, sf_dir)
    cutoff = (c.agg(F.max("sequence")).first()[0] or 0) * 3 // 4
    committed = a.filter(err.item_success() & (F.col("sequence") < cutoff))
    lag = mx.checkpoint_lag(c, committed)
    d = a.groupBy("index").agg(F.count_if(~err.item_success()).alias("dlq_size"),
                               F.max_by("duration_ms", "sequence").alias("last_duration_ms"))
    return lag.join(d, "index", "left")


@register("a12_connection_state", """
SELECT index AS connection, arg_max(CASE WHEN status = 503 THEN 0 ELSE 1 END, sequence) AS state,
  CAST(count_if(attempt > 1 AND status < 500) AS BIGINT) AS reconnects
FROM attempts GROUP BY index""")
def a12_connection_state(spark, sf_dir):
    a = attempts(spark, sf_dir).select(F.col("index").alias("connection"), "sequence",
                                       F.when(F.col("status") == 503, 0).otherwise(1).alias("state"),
                                       ((F.col("attempt") > 1) & (F.col("status") < 500)).alias("reconnect"))
    g = mx.last_value(a, "state", "sequence", by=("connection",), name="state")
    r = a.groupBy("connection").agg(F.count_if("reconnect").alias("reconnects"))
    return g.join(r, "connection")


@register("a16_published", """
SELECT concat('es.acme.', replace(index, '-', '_'), '.',
  CASE WHEN operation = 'partial_update' THEN 'partial' ELSE operation END) AS subject,
  CAST(count(*) AS BIGINT) AS published
FROM changes GROUP BY 1""")
def a16_published(spark, sf_dir):
    return mx.published(changes(spark, sf_dir).select(env.subject("acme").alias("subject")))
