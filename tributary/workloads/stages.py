"""Stage queries: watch (T9), gate (T10), write (T11), end-to-end sync."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.fixtures import changes
from tributary.functions import codec
from tributary.functions import envelope as env
from tributary.operators import filters as flt
from tributary.operators.apply import KeyedTable
from tributary.operators.metrics import changes_total
from tributary.plans import stages
from tributary.sinks.bulk import response_item
from tributary.workloads.applying import _state_sql, typed_state
from tributary.workloads.registry import register

ENVELOPE = ("sequence", "index", "doc_id", "source")


def _cfg() -> stages.SyncConfig:
    chain = flt.FilterChain([flt.IndexFilter(exclude_patterns=("temp_*",))])
    return stages.SyncConfig(tenant="acme", source_id="events", chain=chain, downstream_prefix="sync")


@register("t9_watch", """
SELECT 'watcher' AS component, index, operation, CAST(count(*) AS BIGINT) AS changes
FROM changes GROUP BY index, operation""")
def t9_watch(spark, sf_dir):
    paths = stages.SyncPaths.fresh(spark)
    feed = changes(spark, sf_dir)
    stages.watch(spark, feed, paths, _cfg())
    log = stages.watch(spark, feed, paths, _cfg())   # second poll: cursors committed, nothing new
    return changes_total(log, "watcher")


@register("t10_gate", """
SELECT CAST(count(*) AS BIGINT) AS received, CAST(0 AS BIGINT) AS quarantined,
  CAST(count_if(starts_with(index, 'temp_')) AS BIGINT) AS filtered,
  CAST(count_if(NOT starts_with(index, 'temp_')) AS BIGINT) AS forwarded
FROM changes""")
def t10_gate(spark, sf_dir):
    paths = stages.SyncPaths.fresh(spark)
    stages.watch(spark, changes(spark, sf_dir), paths, _cfg())
    return stages.gate_stage(spark, paths, _cfg())


@register("t11_write", """
SELECT CAST(count(*) AS BIGINT) AS success_count, CAST(0 AS BIGINT) AS failure_count,
  CAST(sum(coalesce(strlen(source), 0) + strlen(index) + strlen(doc_id) + 200) AS BIGINT) AS size_bytes
FROM changes WHERE NOT starts_with(index, 'temp_')""")
def t11_write(spark, sf_dir):
    paths = stages.SyncPaths.fresh(spark)
    cfg = _cfg()
    stages.watch(spark, changes(spark, sf_dir), paths, cfg)
    stages.gate_stage(spark, paths, cfg)
    res = stages.write_stage(spark, paths, cfg)
    return res.agg(F.sum("success_count").cast("bigint").alias("success_count"),
                   F.sum("failure_count").cast("bigint").alias("failure_count"),
                   F.sum("size_bytes").cast("bigint").alias("size_bytes"))


_T12_SQL = _state_sql("(SELECT * FROM changes WHERE NOT starts_with(index, 'temp_'))")


@register("t12_sync", _T12_SQL)
def t12_sync(spark, sf_dir):
    """End-to-end sync (flagship): watch, gate and write, chained by tables."""
    table = stages.sync(spark, changes(spark, sf_dir), _cfg())
    return typed_state(table.read())


@register("t12_sync_staged", _T12_SQL)
def t12_sync_staged(spark, sf_dir):
    """T12 in two batches of the feed, each stage run again in between: a second run adds nothing."""
    feed, cfg, paths = changes(spark, sf_dir), _cfg(), stages.SyncPaths.fresh(spark)
    half = F.floor(F.coalesce(feed.agg(F.max("sequence")).scalar(), F.lit(0)) / 2)
    for part in (feed.filter(F.col("sequence") <= half), feed):
        stages.watch(spark, part, paths, cfg)
        for _ in range(2):
            stages.gate_stage(spark, paths, cfg)
            stages.write_stage(spark, paths, cfg)
    return typed_state(KeyedTable(spark, paths.target).read())


@register("t12_sync_fused", _T12_SQL)
def t12_sync_fused(spark, sf_dir):
    """The shorter form without a published log."""
    return typed_state(stages.sync_fused(spark, changes(spark, sf_dir), _cfg()).read())


#: Changes with every optional field, some bodies missing or damaged.
FULL_SQL = """
SELECT sequence, operation, index, doc_id,
  CASE WHEN sequence % 50 = 6 THEN NULL ELSE source END AS source,
  CASE WHEN sequence % 3 = 0 THEN 'special' ELSE '_doc' END AS doc_type,
  CASE WHEN sequence % 5 = 0 THEN sequence * 2 END AS version,
  CASE WHEN sequence % 7 = 0 THEN CAST(3 AS BIGINT) END AS primary_term,
  CASE WHEN sequence % 4 = 0 THEN concat('c-', CAST(sequence AS VARCHAR)) END AS correlation_id,
  CASE WHEN sequence % 6 = 0 THEN concat('h"', CAST(sequence % 9 AS VARCHAR)) END AS header,
  CASE WHEN sequence % 8 = 0 THEN 'r/1' END AS routing, CASE WHEN sequence % 9 = 0 THEN 'pipe' END AS pipeline
FROM changes WHERE sequence % 50 <> 7"""


def full_changes(spark, sf_dir):
    seq = F.col("sequence")
    c = changes(spark, sf_dir).filter(seq % 50 != 7)
    return c.withColumns({
        "source": F.when(seq % 50 == 6, F.lit(None).cast("string")).otherwise(F.col("source")),
        "doc_type": F.when(seq % 3 == 0, "special").otherwise("_doc"),
        "version": F.when(seq % 5 == 0, seq * 2), "primary_term": F.when(seq % 7 == 0, F.lit(3).cast("bigint")),
        "correlation_id": F.when(seq % 4 == 0, F.concat(F.lit("c-"), seq.cast("string"))),
        "headers": F.when(seq % 6 == 0, F.create_map(F.lit("k"), F.concat(F.lit('h"'), (seq % 9).cast("string")))),
        "routing": F.when(seq % 8 == 0, "r/1"), "pipeline": F.when(seq % 9 == 0, "pipe")})


_PASSING = "operation <> 'delete' AND NOT starts_with(index, 'temp_')"


def _full_cfg():
    chain = flt.FilterChain([flt.IndexFilter(exclude_patterns=("temp_*",)), flt.writes_only()])
    return stages.SyncConfig(tenant="acme", source_id="events", chain=chain, fetch=None, batch_size=7, batch_bytes=2000,
                             tick_ms=3_600_000)


@register("t10_gate_full_envelope", f"""
SELECT 'forwarded' AS outcome, sequence, doc_type, version, primary_term, correlation_id, header, routing, pipeline
FROM full_feed WHERE {_PASSING}
UNION ALL
SELECT 'quarantined', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM full_feed WHERE sequence % 40 = 1""",
          ctes=(("full_feed", FULL_SQL),))
def t10_gate_full_envelope(spark, sf_dir):
    """T10 with all envelope fields and with damaged payloads in the log; run twice."""
    paths, cfg = stages.SyncPaths.fresh(spark), _full_cfg()
    feed = full_changes(spark, sf_dir)
    log = stages.watch(spark, feed, paths, cfg)
    # damaged copies of some payloads arrive in a batch of their own
    cut = log.filter(F.col("sequence") % 40 == 1).withColumn("payload", F.expr("substr(payload, 1, 40)")).drop("batch")
    stages._write(cut, paths.log, "batch=00000001", "index")
    stages._write(cut.select("index", F.lit(-1).cast("bigint").alias("cursor")), paths.cursors, "batch=00000001")
    for _ in range(2):
        stages.gate_stage(spark, paths, cfg)
    got = stages._read(spark, paths.gated).filter("outcome <> 'filtered'").select("outcome", "payload")
    back = codec.decode(got, keep=("outcome",))
    return back.select("outcome", "sequence", F.when(F.col("sequence").isNotNull(), F.col("doc_type")).alias("doc_type"),
                       "version", "primary_term", "correlation_id", F.element_at("headers", "k").alias("header"),
                       "routing", "pipeline")


@register("t11_write_results", f"""
SELECT sequence % 50 = 6 AS failed, index, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(coalesce(strlen(source), 0) + strlen(index) + strlen(doc_id) + 200) AS BIGINT) AS size_bytes
FROM full_feed WHERE {_PASSING} GROUP BY 1, 2""", ctes=(("full_feed", FULL_SQL),))
def t11_write_results(spark, sf_dir):
    """T11 with documents the store cannot take; a second run leaves results, DLQ and table as they are."""
    paths, cfg = stages.SyncPaths.fresh(spark), _full_cfg()
    stages.watch(spark, full_changes(spark, sf_dir), paths, cfg)
    stages.gate_stage(spark, paths, cfg)
    for _ in range(2):
        stages.write_stage(spark, paths, cfg)
    table = KeyedTable(spark, paths.target)
    held = spark.read.schema(table.CHANGES).parquet(*[f"{paths.target}/{b}" for b in table.manifest()["batches"].values()])
    tried = held.select(F.lit(False).alias("failed"), *ENVELOPE).unionByName(
        stages._read(spark, paths.dlq).select(F.lit(True).alias("failed"), *ENVELOPE))
    return tried.groupBy("failed", "index").agg(F.count(F.lit(1)).alias("n"), F.sum(env.envelope_size()).cast("bigint").alias("size_bytes"))


@register("o4_dlq_drain", f"""
SELECT CAST(3 AS INTEGER) AS attempts, CAST(count(*) AS BIGINT) AS n FROM full_feed
WHERE {_PASSING} AND sequence % 50 = 6 AND sequence % 4 <> 2 HAVING count(*) > 0""", ctes=(("full_feed", FULL_SQL),))
def o4_dlq_drain(spark, sf_dir):
    """Two drains; what succeeds leaves the DLQ for the table, the rest counts its attempts."""
    paths, cfg = stages.SyncPaths.fresh(spark), _full_cfg()
    stages.watch(spark, full_changes(spark, sf_dir), paths, cfg)
    stages.gate_stage(spark, paths, cfg)
    stages.write_stage(spark, paths, cfg)
    for _ in range(2):
        left = stages.drain_dlq(spark, paths, lambda: F.col("sequence") % 4 == 2)
    return left.groupBy("attempts").agg(F.count(F.lit(1)).alias("n"))


def _store():
    """A store's answers to bulk requests: refuses some documents, and is away for others the first time."""
    calls = []

    def send(requests):
        calls.append(1)
        lines = requests.select("lane", "tick", "batch_no", F.posexplode(F.split("body", "\n")).alias("p", "line"))
        lines = lines.filter(F.col("line").rlike(r'^\s*\{\s*"(index|update|delete)"'))
        # exploding the one parsed value keeps the filter above the parse: each line is parsed once
        m = F.from_json("line", "map<string, struct<_index: string, _id: string>>")
        asked = lines.select("lane", "tick", "batch_no", "p", F.explode(F.array(m)).alias("m")).withColumn(
            "action", F.map_keys("m")[0]).filter(F.col("action").isin("index", "update", "delete") & F.map_values("m")[0]["_id"].isNotNull())
        target = F.map_values("m")[0]
        number = F.expr("try_cast(substr(map_values(m)[0]._id, 2) as bigint)")
        status = (F.when(number % 11 == 3, 400).when((number % 7 == 2) & F.lit(len(calls) == 1), 503)
                  .when(number % 13 == 5, 503).otherwise(200))
        kind = F.when(status == 400, "mapper_parsing_exception").when(status == 503, "timeout_exception")
        item = response_item(F.col("action"), target["_index"], target["_id"], status, kind, F.when(status >= 300, "refused"))
        g = asked.groupBy("lane", "tick", "batch_no").agg(F.array_sort(F.collect_list(F.struct("p", item.alias("i")))).alias("xs"))
        body = F.concat(F.lit('{"took":1,"errors":true,"items":['), F.array_join(F.transform("xs", lambda x: x["i"]), ","), F.lit("]}"))
        return g.select("lane", "tick", "batch_no", body.alias("body"))
    return send


@register("t11_store_answers", """
SELECT CASE WHEN n % 11 = 3 THEN 'mapper_parsing_exception' WHEN n % 13 = 5 THEN 'timeout_exception' END AS error_kind,
  CAST(CASE WHEN n % 11 = 3 THEN 1 WHEN n % 13 = 5 THEN 3 END AS INTEGER) AS attempts, index, CAST(count(*) AS BIGINT) AS n
FROM (SELECT *, TRY_CAST(substr(doc_id, 2) AS BIGINT) AS n FROM changes WHERE NOT starts_with(index, 'temp_')) c
GROUP BY ALL""")
def t11_store_answers(spark, sf_dir):
    """T11 by a store's answers: matched by position, 5xx sent again, 4xx to the DLQ at once."""
    paths = stages.SyncPaths.fresh(spark)
    cfg = _cfg()
    cfg.send, cfg.tick_ms, cfg.batch_size = _store(), 60_000, 50
    stages.watch(spark, changes(spark, sf_dir), paths, cfg)
    stages.gate_stage(spark, paths, cfg)
    stages.write_stage(spark, paths, cfg)
    table = KeyedTable(spark, paths.target)
    held = spark.read.schema(table.CHANGES).parquet(*[f"{paths.target}/{b}" for b in table.manifest()["batches"].values()])
    none = F.lit(None)
    told = stages._read(spark, paths.dlq).select("error_kind", "attempts", "index").unionByName(
        held.select(none.cast("string").alias("error_kind"), none.cast("int").alias("attempts"), "index"))
    return told.groupBy("error_kind", "attempts", "index").agg(F.count(F.lit(1)).alias("n"))
