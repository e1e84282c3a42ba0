"""Cursor scans and polls (S1-S3, S8, S9, T5, A1, A17), retention (K3),
forward subjects (K4), key-set lookups (J4) and set membership (U2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.fixtures import changes
from tributary.functions import envelope as env
from tributary.operators import filters as flt
from tributary.operators.apply import latest_per_key
from tributary.operators.metrics import pending, published
from tributary.session import scratch_path
from tributary.sources import cursor as cur
from tributary.sources import retention
from tributary.workloads.registry import register

_COLS = ("sequence", "index", "doc_id", "operation")


def _max_seq(df):
    """A cursor position, as a scalar of the same plan."""
    return F.coalesce(df.agg(F.max("sequence")).scalar(), F.lit(0))


@register("s1_cursor_scan", """
SELECT sequence, index, doc_id, operation FROM changes
WHERE starts_with(index, 'app-') AND sequence > (SELECT max(sequence) // 3 FROM changes)
ORDER BY sequence LIMIT 1000""")
def s1_cursor_scan(spark, sf_dir):
    c = changes(spark, sf_dir)
    return cur.scan(c, F.floor(_max_seq(c) / 3), 1000, ["app-*"]).select(*_COLS)


@register("t5_seek", """
SELECT sequence, index, doc_id, operation FROM changes
WHERE sequence > (SELECT max(sequence) // 4 FROM changes)
ORDER BY sequence LIMIT 200""")
def t5_seek(spark, sf_dir):
    c = changes(spark, sf_dir)
    return cur.scan(c, F.floor(_max_seq(c) / 4), 200).select(*_COLS)


_CUR_SQL = "SELECT index, max(sequence) // 2 AS cursor FROM changes GROUP BY index"
_POLL_SQL = f"""
SELECT c.sequence, c.index, c.doc_id, c.operation FROM changes c LEFT JOIN ({_CUR_SQL}) k USING (index)
WHERE (starts_with(c.index, 'app-') OR c.index IN ('temp_error', 'temp_view'))
  AND c.sequence > coalesce(k.cursor, -1)
ORDER BY c.sequence, c.index, c.doc_id LIMIT 500"""


def _cursors(c):
    return c.groupBy("index").agg(F.floor(F.max("sequence") / 2).cast("bigint").alias("cursor"))


def _poll(spark, sf_dir):
    c = changes(spark, sf_dir)
    return cur.poll_per_index(c, _cursors(c), ["app-*", "temp_error", "temp_view"], 500)


@register("s2_multi_pattern_poll", _POLL_SQL)
def s2_multi_pattern_poll(spark, sf_dir):
    return _poll(spark, sf_dir).select(*_COLS)


@register("a1_max_sequence", f"""
SELECT index, max(sequence) AS cursor FROM ({_POLL_SQL}) p GROUP BY index""")
def a1_max_sequence(spark, sf_dir):
    return cur.next_cursor(_poll(spark, sf_dir), by=("index",))


@register("s3_poll_union", """
SELECT * FROM (SELECT sequence, index, doc_id, operation, 'app-*' AS pattern FROM changes
  WHERE starts_with(index, 'app-') AND sequence > (SELECT max(sequence) // 2 FROM changes)
  ORDER BY sequence, index, doc_id LIMIT 300) a
UNION ALL
SELECT * FROM (SELECT sequence, index, doc_id, operation, '*-click' AS pattern FROM changes
  WHERE ends_with(index, '-click') AND sequence > (SELECT max(sequence) // 2 FROM changes)
  ORDER BY sequence, index, doc_id LIMIT 300) b""")
def s3_poll_union(spark, sf_dir):
    c = changes(spark, sf_dir)
    return cur.poll_union(c, ["app-*", "*-click"], F.floor(_max_seq(c) / 2), 300).select(*_COLS, "pattern")


#: The feed with three changes to a sequence number, so limits fall inside ties.
_TIED = "(SELECT sequence // 3 AS sequence, index, doc_id, operation FROM changes)"


def _tied(spark, sf_dir):
    return changes(spark, sf_dir).withColumn("sequence", F.floor(F.col("sequence") / 3).cast("bigint"))


_TIED_POLL_SQL = f"""
SELECT t.* FROM {_TIED} t LEFT JOIN (SELECT index, max(sequence) // 2 AS cursor FROM {_TIED} c GROUP BY index) k USING (index)
WHERE starts_with(t.index, 'app-') AND t.sequence > coalesce(k.cursor, -1)"""


@register("s2_poll_ties", f"""
SELECT * FROM ({_TIED_POLL_SQL}) p
WHERE sequence <= (SELECT max(sequence) FROM (SELECT sequence FROM ({_TIED_POLL_SQL}) q ORDER BY sequence LIMIT 100))""")
def s2_poll_ties(spark, sf_dir):
    """S2 where the limit falls inside a tie: the poll grows to the whole tie."""
    c = _tied(spark, sf_dir)
    cursors = c.groupBy("index").agg(F.floor(F.max("sequence") / 2).cast("bigint").alias("cursor"))
    return cur.poll_per_index(c, cursors, ["app-*"], 100).select(*_COLS)


@register("s3_union_ties", f"""
SELECT * FROM {_TIED} a WHERE starts_with(index, 'app-') AND sequence <= (SELECT max(sequence) FROM (
  SELECT sequence FROM {_TIED} b WHERE starts_with(index, 'app-') ORDER BY sequence LIMIT 100))
UNION ALL
SELECT * FROM {_TIED} a WHERE ends_with(index, '-click') AND sequence <= (SELECT max(sequence) FROM (
  SELECT sequence FROM {_TIED} b WHERE ends_with(index, '-click') ORDER BY sequence LIMIT 100))""")
def s3_union_ties(spark, sf_dir):
    return cur.poll_union(_tied(spark, sf_dir), ["app-*", "*-click"], limit=100).select(*_COLS)


@register("a1_poll_until_empty", f"""
SELECT CAST(count(*) AS BIGINT) AS delivered, CAST(0 AS BIGINT) AS left_over FROM {_TIED} t
WHERE sequence <= (SELECT max(sequence) FROM (SELECT sequence FROM (
  SELECT sequence FROM {_TIED} u WHERE sequence > (SELECT max(sequence) FROM (SELECT sequence FROM {_TIED} v ORDER BY sequence LIMIT 100))
  ORDER BY sequence LIMIT 100)))""")
def a1_poll_until_empty(spark, sf_dir):
    """A1 with S1: two polls in a row, the second from the first one's cursor, pass over no row."""
    c = _tied(spark, sf_dir)
    first = cur.scan(c, limit=100)
    at = cur.next_cursor(first).scalar()
    second = cur.scan(c, at, 100)
    end = cur.next_cursor(second).scalar()
    got = first.unionByName(second)
    n = got.agg(F.count(F.lit(1)).alias("delivered"))
    upto = c.filter(F.col("sequence") <= end).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("left_over", upto.scalar() - F.col("delivered"))


@register("s8_subject_subscribe", """
SELECT sequence, concat('es.acme.', replace(index, '-', '_'), '.',
  CASE WHEN operation = 'partial_update' THEN 'partial' ELSE operation END) AS subject
FROM changes
WHERE replace(index, '-', '_') = 'app_click' OR index = 'temp_view' OR operation = 'delete'""")
def s8_subject_subscribe(spark, sf_dir):
    sub = flt.SubjectFilter("acme", ("es.acme.app_click.*", "es.acme.temp_view.>", "es.acme.*.delete"))
    chain = flt.FilterChain([sub])
    return flt.apply_chain(changes(spark, sf_dir), chain).select("sequence", sub.subject_col().alias("subject"))


@register("s8_many_subscriptions", """
SELECT sequence, p.pattern FROM (SELECT *, replace(index, '-', '_') AS i FROM changes) c,
  LATERAL (SELECT unnest([concat('es.acme.', i, '.*.', doc_id), concat('es.acme.', i, '.>'), '>', '*.acme.*.*.*',
    CASE WHEN operation = 'delete' THEN concat('es.*.*.delete.', doc_id) END]) AS pattern) p
WHERE p.pattern IS NOT NULL""")
def s8_many_subscriptions(spark, sf_dir):
    """A subscription per document and index, per document's deletes, and wide ones, matched together."""
    from tributary.operators.subscriptions import subscribe
    c = changes(spark, sf_dir)
    token = env.subject_index_token()
    own = c.select(F.explode(F.array(
        F.concat(F.lit("es.acme."), token, F.lit(".*."), "doc_id"), F.concat(F.lit("es.*.*.delete."), "doc_id"),
        F.concat(F.lit("es.acme."), token, F.lit(".>")))).alias("pattern")).distinct()
    wide = spark.createDataFrame([(p,) for p in (">", "*.acme.*.*.*", "es.acme.*.*", "es.acme.app_*.index.>", "acme.>")], "pattern string")
    return subscribe(c, own.unionByName(wide), F.concat(env.subject("acme"), F.lit("."), "doc_id")).select("sequence", "pattern")


_W4_SQL = """SELECT index, doc_id, sequence, operation, source FROM (
  SELECT *, row_number() OVER (PARTITION BY index, doc_id ORDER BY sequence DESC) AS rn FROM changes) t
  WHERE rn = 1 AND operation <> 'delete'"""


@register("s9_point_lookup", f"""
SELECT * FROM ({_W4_SQL}) s WHERE (index = 'app-click' AND doc_id = 'u1')
  OR (index = 'app-view' AND doc_id = 'u7')""")
def s9_point_lookup(spark, sf_dir):
    state = latest_per_key(changes(spark, sf_dir))
    return cur.point_lookup(state, "app-click", "u1").unionByName(cur.point_lookup(state, "app-view", "u7"))


@register("j4_multi_get", f"""
SELECT * FROM ({_W4_SQL}) s
WHERE (index, doc_id) IN (SELECT DISTINCT replace(index, 'temp_', 'app-'), doc_id FROM changes
                          WHERE starts_with(index, 'temp_'))""")
def j4_multi_get(spark, sf_dir):
    c = changes(spark, sf_dir)
    keys = c.filter(F.col("index").startswith("temp_")).select(
        F.regexp_replace("index", "^temp_", "app-").alias("index"), "doc_id")
    return cur.multi_get(latest_per_key(c), keys)


@register("a17_pending", f"""
SELECT c.index, CAST(count(*) AS BIGINT) AS pending FROM changes c JOIN ({_CUR_SQL}) k USING (index)
WHERE c.sequence > k.cursor GROUP BY c.index""")
def a17_pending(spark, sf_dir):
    c = changes(spark, sf_dir)
    j = c.join(_cursors(c), "index")
    return j.filter(F.col("sequence") > F.col("cursor")).groupBy("index").agg(F.count(F.lit(1)).alias("pending"))


@register("a17_pending_global", """
SELECT CAST(count(*) AS BIGINT) AS pending FROM changes
WHERE sequence > (SELECT max(sequence) * 9 // 10 FROM changes)""")
def a17_pending_global(spark, sf_dir):
    c = changes(spark, sf_dir)
    return pending(c, F.floor(_max_seq(c) * 9 / 10))


@register("k3_retention_24h", """
SELECT index, CAST(count(*) AS BIGINT) AS n, min(timestamp) AS oldest FROM changes
WHERE timestamp > (SELECT max(timestamp) FROM changes) - INTERVAL 24 HOUR GROUP BY index""")
def k3_retention_24h(spark, sf_dir):
    kept = cur.retention(changes(spark, sf_dir), 24)
    return kept.groupBy("index").agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("oldest"))


@register("k3_retention_days", """
SELECT index, CAST(count(*) AS BIGINT) AS n, min(timestamp) AS oldest FROM changes
WHERE timestamp > (SELECT max(timestamp) FROM changes) - INTERVAL 240 HOUR GROUP BY index""")
def k3_retention_days(spark, sf_dir):
    """K3 on disk: a log by days; expired days are dropped, reads prune the rest."""
    path, feed = scratch_path(spark, "retained"), changes(spark, sf_dir)
    retention.append(feed, path)
    newest = feed.agg(F.max("timestamp")).first()[0]
    if newest is None:
        return feed.groupBy("index").agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("oldest"))
    retention.drop_expired(spark, path, newest, 240)
    return retention.read(spark, path, newest, 240).groupBy("index").agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("oldest"))


@register("k4_forward_subject", """
SELECT concat('downstream.', replace(index, '-', '_')) AS subject, CAST(count(*) AS BIGINT) AS published
FROM changes WHERE operation IN ('index', 'update', 'partial_update') GROUP BY 1""")
def k4_forward_subject(spark, sf_dir):
    fwd = flt.apply_chain(changes(spark, sf_dir), flt.FilterChain([flt.writes_only()]))
    return published(fwd.select(env.forward_subject("downstream").alias("subject")))


@register("u2_large_include_list", """
SELECT index, CAST(count(*) AS BIGINT) AS n FROM changes
WHERE doc_id IN (SELECT doc_id FROM changes WHERE starts_with(index, 'temp_'))
  AND doc_id NOT IN (SELECT concat('u', CAST(user_id AS VARCHAR)) FROM events
                     WHERE event_type = 'error' AND value > 400)
GROUP BY index""")
def u2_large_include_list(spark, sf_dir):
    from tributary.sources.tables import read_table
    c = changes(spark, sf_dir)
    include = c.filter(F.col("index").startswith("temp_")).select("doc_id").distinct()
    ev = read_table(spark, sf_dir, "events")
    exclude = ev.filter((F.col("event_type") == "error") & (F.col("value") > 400)).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("doc_id")).distinct()
    kept = c.join(include, "doc_id", "left_semi")
    kept = kept.join(exclude, "doc_id", "left_anti")
    return kept.groupBy("index").agg(F.count(F.lit(1)).alias("n"))


_SHA = ("sha256(concat_ws('#', 'events', index, doc_id, CAST(sequence AS VARCHAR)))")
_SHA_UUID = ("concat(substr(s, 1, 8), '-', substr(s, 9, 4), '-', substr(s, 13, 4), '-', "
             "substr(s, 17, 4), '-', substr(s, 21, 12))")


def _delivered(spark, sf_dir):
    from tributary.fixtures import redelivered
    return redelivered(spark, sf_dir).withColumn("source_id", F.lit("events")).withColumn("msg_id", env.message_id())


@register("j3_unacked", f"""
SELECT {_SHA_UUID} AS msg_id, CAST(count(*) AS BIGINT) AS deliveries, min(sequence) AS sequence
FROM (SELECT r.*, {_SHA} AS s FROM redelivered r) d
WHERE sequence NOT IN (SELECT sequence FROM attempts WHERE status BETWEEN 200 AND 299)
GROUP BY 1""")
def j3_unacked(spark, sf_dir):
    from tributary.fixtures import attempts
    from tributary.sources.feed import unacked
    d = _delivered(spark, sf_dir)
    ok = attempts(spark, sf_dir).filter(F.col("status").between(200, 299)).withColumn(
        "source_id", F.lit("events")).withColumn("msg_id", env.message_id())
    return unacked(d, ok)


@register("j3_nacked", f"""
SELECT sequence, {_SHA_UUID} AS msg_id FROM (SELECT r.*, {_SHA} AS s FROM redelivered r) d
WHERE sequence IN (SELECT sequence FROM attempts WHERE status BETWEEN 500 AND 599)""")
def j3_nacked(spark, sf_dir):
    from tributary.fixtures import attempts
    from tributary.sources.feed import nacked
    d = _delivered(spark, sf_dir)
    n = attempts(spark, sf_dir).filter(F.col("status").between(500, 599)).withColumn(
        "source_id", F.lit("events")).withColumn("msg_id", env.message_id())
    return nacked(d, n).select("sequence", "msg_id")


@register("x3_change_source", """
SELECT CAST(count(*) AS BIGINT) AS pending FROM changes
WHERE starts_with(index, 'app-') AND sequence > (SELECT max(sequence) // 2 FROM changes)""")
def x3_change_source(spark, sf_dir):
    from tributary.sources.feed import ChangeSource
    src = ChangeSource(lambda s: changes(s, sf_dir), patterns=["app-*"])
    return src.pending(spark, F.floor(_max_seq(changes(spark, sf_dir)) / 2))
