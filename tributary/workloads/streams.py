"""Streaming queries (S6, S7, K1, K2, K5, T1, T7, T13, F25), each drained with
``availableNow`` into the shared folder and read back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tributary.fixtures import changes, wire_from_changes
from tributary.functions import codec
from tributary.functions import envelope as env
from tributary.operators import batching as bt
from tributary.session import scratch_path
from tributary.sources import change_log
from tributary.streaming import batcher, feeds, lateness
from tributary.workloads.registry import register
from tributary.workloads.writing import W2_SQL

_H = "md5(concat(index, '#', doc_id, '#', CAST(sequence AS VARCHAR(20))))"
_UUID = "concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12))"


@register("s6_stream_consume", f"""
SELECT sequence, {_UUID} AS msg_id, operation, index, doc_id, source
FROM (SELECT c.*, {_H} AS h FROM changes c) x
WHERE sequence % 97 <> 0 AND sequence % 101 <> 0 AND sequence % 103 <> 0""")
def s6_stream_consume(spark, sf_dir):
    out = scratch_path(spark, "streams/s6")
    decoded = codec.valid(codec.decode(wire_from_changes(feeds.changes_stream(spark, sf_dir))))
    feeds.run(decoded.select("sequence", "msg_id", "operation", "index", "doc_id", "source"),
              path=out, name="s6")
    return spark.read.parquet(out)


@register("s7_batch_consume", """
SELECT CAST(count(*) AS BIGINT) AS n, min(sequence) AS first_seq, max(sequence) AS last_seq FROM changes""")
def s7_batch_consume(spark, sf_dir):
    out = scratch_path(spark, "streams/s7")
    feeds.run(feeds.changes_stream(spark, sf_dir), foreach_batch=feeds.consume_batch(out, "sequence"), name="s7")
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n"), F.min("sequence").alias("first_seq"),
                                       F.max("sequence").alias("last_seq"))


_SUBJ = """concat('es.acme.', replace(index, '-', '_'), '.',
  CASE WHEN operation = 'partial_update' THEN 'partial' ELSE operation END)"""


@register("k1_publish", f"SELECT {_SUBJ} AS subject, CAST(count(*) AS BIGINT) AS published FROM changes GROUP BY 1")
def k1_publish(spark, sf_dir):
    out = scratch_path(spark, "streams/k1")
    s = feeds.changes_stream(spark, sf_dir)
    s = s.select(env.subject("acme").alias("subject"), "index", "sequence", "operation")
    feeds.run(s, path=out, partition_by=("index",), name="k1")
    return spark.read.parquet(out).groupBy("subject").agg(F.count(F.lit(1)).alias("published"))


@register("k2_publish_batch_count", "SELECT CAST(count(*) AS BIGINT) AS published FROM changes")
def k2_publish_batch_count(spark, sf_dir):
    log, counts = scratch_path(spark, "streams/k2log"), scratch_path(spark, "streams/k2counts")
    feeds.run(feeds.changes_stream(spark, sf_dir), foreach_batch=feeds.publish_batch(log, counts, "acme"), name="k2")
    per_batch = spark.read.parquet(counts).groupBy("batch_id").agg(F.sum("published").alias("published"))
    return per_batch.agg(F.sum("published").cast("bigint").alias("published"))


@register("k5_fan_out", """
SELECT index, CAST(count(*) AS BIGINT) AS n_log, CAST(count(*) AS BIGINT) AS n_counted FROM changes GROUP BY index""")
def k5_fan_out(spark, sf_dir):
    log, counts = scratch_path(spark, "streams/k5log"), scratch_path(spark, "streams/k5counts")
    feeds.run(feeds.changes_stream(spark, sf_dir), foreach_batch=feeds.publish_batch(log, counts, "acme"), name="k5")
    a = spark.read.parquet(log).groupBy("index").agg(F.count(F.lit(1)).alias("n_log"))
    b = spark.read.parquet(counts).groupBy("index").agg(F.sum("published").cast("bigint").alias("n_counted"))
    return a.join(b, "index", "full_outer")


@register("t1_resume", "SELECT sequence, index, doc_id, operation FROM changes")
def t1_resume(spark, sf_dir):
    out, ckpt = scratch_path(spark, "streams/t1"), scratch_path(spark, "checkpoints/t1")
    s = feeds.changes_stream(spark, sf_dir).select("sequence", "index", "doc_id", "operation")
    feeds.run(s, path=out, checkpoint=ckpt, name="t1")
    feeds.run(s, path=out, checkpoint=ckpt, name="t1")   # restart: offsets committed, nothing re-read
    return spark.read.parquet(out)


@register("t7_dedupe", """
SELECT sequence, index, doc_id, operation FROM (SELECT * FROM redelivered) r
GROUP BY sequence, index, doc_id, operation""")
def t7_dedupe(spark, sf_dir):
    out = scratch_path(spark, "streams/t7")
    a = feeds.changes_stream(spark, sf_dir)
    b = feeds.changes_stream(spark, sf_dir).filter(F.col("sequence") % 5 == 0)
    redelivered = a.unionByName(b).withColumn("source_id", F.lit("events")).withColumn("msg_id", env.message_id())
    d = feeds.dedupe(redelivered).select("sequence", "index", "doc_id", "operation")
    feeds.run(d, path=out, name="t7")
    return spark.read.parquet(out)


@register("t13_stream_metrics", """
SELECT date_trunc('hour', timestamp) AS window_start, index, CAST(count(*) AS BIGINT) AS n
FROM changes GROUP BY 1, 2""")
def t13_stream_metrics(spark, sf_dir):
    out = scratch_path(spark, "streams/t13")
    counts = feeds.windowed_counts(feeds.changes_stream(spark, sf_dir), "1 hour")
    # update mode: state is dropped behind the watermark; each batch appends the
    # rows it changed, readers keep the latest batch per (window, labels)
    feeds.run(counts, foreach_batch=feeds.append_updates(out), output_mode="update", name="t13")
    return feeds.latest_updates(spark.read.parquet(out), ("window_start", "index"))


@register("w2_stream", W2_SQL)
def w2_stream(spark, sf_dir):
    """A writer's buffer over five micro-batches, stopped and restarted after the third."""
    src, out, ckpt = scratch_path(spark, "streams/w2src"), scratch_path(spark, "streams/w2"), scratch_path(spark, "checkpoints/w2")
    c = changes(spark, sf_dir)
    top = c.agg(F.coalesce(F.max("sequence"), F.lit(0)) + 1).scalar()
    part = F.floor(F.col("sequence") * 5 / top)
    for i in range(5):                        # the feed in order of sequence, a file each
        c.filter(part == i).coalesce(1).write.mode("append").parquet(src)
        if i in (2, 4):
            stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(src)
            feeds.run(batcher.batch_stream(stream, F.col("source"), bt.sequence_lane(4), 4096, 9, 86_400_000),
                      path=out, checkpoint=ckpt, name="w2")
    return spark.read.parquet(out).unionByName(batcher.open_batches(spark, ckpt)).select(
        "sequence", "lane", "tick", "batch_no", "batch_pos")


_LATE_TS = "CASE WHEN sequence % 50 = 7 THEN timestamp - INTERVAL 3 DAY ELSE timestamp END"


@register("t13_late_rows", f"""
WITH RECURSIVE r AS (SELECT sequence, index, sequence % 4 AS lane, epoch_us({_LATE_TS}) AS us FROM changes),
m AS (SELECT *, us // 3600000000 * 3600000000 AS w,
        max(us) OVER (PARTITION BY index, lane ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock FROM r),
l AS (SELECT *, coalesce(w + 7200000000 <= clock, false) AS late FROM m)
SELECT index, w AS window_us, late, CAST(count(*) AS BIGINT) AS n,
  CAST(CASE WHEN late THEN max(clock - (w + 7200000000)) END AS BIGINT) AS most_late_us
FROM l GROUP BY index, w, late""")
def t13_late_rows(spark, sf_dir):
    """Hourly counts over three micro-batches with rows three days behind: none is lost."""
    src, counts, late, ckpt = (scratch_path(spark, f"streams/late{n}") for n in ("src", "counts", "rows", "ckpt"))
    c = changes(spark, sf_dir)
    c = c.withColumn("timestamp", F.when(F.col("sequence") % 50 == 7, F.col("timestamp") - F.expr("INTERVAL 3 DAYS")).otherwise(F.col("timestamp")))
    top = c.agg(F.coalesce(F.max("sequence"), F.lit(0)) + 1).scalar()
    for i in range(3):
        c.filter(F.floor(F.col("sequence") * 3 / top) == i).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(src)
    feeds.run(lateness.counted(stream, 3_600_000, 3_600_000), foreach_batch=lateness.split_sink(counts, late),
              checkpoint=ckpt, output_mode="update", name="late")
    n = lateness.current_counts(spark.read.parquet(counts)).select(
        "index", "window_us", F.lit(False).alias("late"), "n", F.lit(None).cast("bigint").alias("most_late_us"))
    behind = lateness.late_rows(spark.read.parquet(late)).groupBy("index", "window_us").agg(
        F.count(F.lit(1)).alias("n"), F.max("late_us").alias("most_late_us"))
    return n.unionByName(behind.withColumn("late", F.lit(True)))


_LOG_COLUMNS = ("sequence", "index", "doc_id", "operation")


def _drain(stream, path, checkpoint):
    """Run until the source has no more, over as many micro-batches as its limit makes, and stop."""
    q = stream.writeStream.format(change_log.FORMAT).option("checkpointLocation", checkpoint).trigger(
        processingTime="0 seconds").start(path)
    q.processAllAvailable()
    q.stop()


@register("t1_log_resume", """
SELECT sequence, index, doc_id, operation, false AS sought FROM changes
UNION ALL SELECT sequence, index, doc_id, operation, true FROM changes WHERE sequence > (SELECT max(sequence) // 2 FROM changes)""")
def t1_log_resume(spark, sf_dir):
    """A log read by sequence in limited micro-batches, stopped, extended and resumed; then read again from its middle."""
    change_log.register(spark)
    log, out, ckpt = (scratch_path(spark, f"streams/log{n}") for n in ("src", "out", "ckpt"))
    c = changes(spark, sf_dir).select(*_LOG_COLUMNS)
    top = c.agg(F.coalesce(F.max("sequence"), F.lit(0))).scalar()
    part = F.floor(F.col("sequence") * 4 / (top + 1))
    for i in range(4):
        for _ in range(1 + i % 2):            # odd epochs are written twice
            c.filter(part == i).write.format(change_log.FORMAT).options(epoch=f"part{i}", rows_per_mark=1000).mode("append").save(log)
        if i in (1, 3):
            _drain(spark.readStream.format(change_log.FORMAT).option("rows_per_batch", 5000).load(log), out, ckpt)
    resumed = spark.read.format(change_log.FORMAT).load(out)
    middle = c.agg(F.floor(F.coalesce(F.max("sequence"), F.lit(0)) / 2)).first()[0]
    sought = spark.read.format(change_log.FORMAT).option("start", middle).load(log)
    return resumed.withColumn("sought", F.lit(False)).unionByName(sought.withColumn("sought", F.lit(True)))


@register("k1_log_sink", f"""
SELECT {_SUBJ} AS subject, CAST(count(*) AS BIGINT) AS published, min(sequence) AS first_seq, max(sequence) AS last_seq
FROM changes GROUP BY 1""")
def k1_log_sink(spark, sf_dir):
    """Envelopes published by a stream into a log; what isn't committed, or was before, adds nothing."""
    change_log.register(spark)
    log, ckpt = scratch_path(spark, "streams/k1log"), scratch_path(spark, "checkpoints/k1log")
    s = feeds.changes_stream(spark, sf_dir).select(env.subject("acme").alias("subject"), "sequence", "index", "operation")
    for _ in range(2):                        # the second run finds its epochs committed
        q = s.writeStream.format(change_log.FORMAT).option("checkpointLocation", ckpt).trigger(availableNow=True).start(log)
        q.awaitTermination()
    return spark.read.format(change_log.FORMAT).load(log).groupBy("subject").agg(
        F.count(F.lit(1)).alias("published"), F.min("sequence").alias("first_seq"), F.max("sequence").alias("last_seq"))


_SPEC_A = {"version": 1, "mode": "all", "filters": [{"type": "operation", "exclude": ["delete"]}]}
_SPEC_B = {"version": 2, "mode": "all", "filters": [{"type": "index", "include_patterns": ["temp_*"]}]}


@register("f25_swap_filters", """
SELECT sequence, 1 AS spec_version FROM changes WHERE sequence % 2 = 0 AND operation <> 'delete'
UNION ALL SELECT sequence, 2 FROM changes WHERE sequence % 2 = 1 AND starts_with(index, 'temp_')""")
def f25_swap_filters(spark, sf_dir):
    """One running stream; the spec table gets a new version while its first micro-batch is done."""
    src, out, specs = (scratch_path(spark, f"streams/f25{n}") for n in ("src", "out", "specs"))
    c = changes(spark, sf_dir)
    for rest in (0, 1):                       # two sets of files, one per micro-batch, in this order
        c.filter(F.col("sequence") % 2 == rest).repartition(4).write.mode("append").parquet(src)

    def write_spec(spec):
        spark.createDataFrame([(spec["version"], json.dumps(spec))], "version int, spec string").write.mode(
            "append").parquet(specs)

    def read_spec():
        return json.loads(spark.read.parquet(specs).orderBy(F.col("version").desc()).first()["spec"])

    gate = feeds.gate_with_reloaded_spec(read_spec, out)

    def swap_after_first(batch, batch_id):
        gate(batch, batch_id)
        if batch_id == 0:
            write_spec(_SPEC_B)

    write_spec(_SPEC_A)
    stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 4).parquet(src)
    feeds.run(stream, foreach_batch=swap_after_first, name="f25")
    return spark.read.parquet(out).select("sequence", F.col("spec_version").cast("int").alias("spec_version"))
