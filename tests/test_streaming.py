"""Streams: restart adds nothing, stream result equals batch result, memory sink."""

import time

from pyspark.sql import functions as F

from tributary.fixtures import changes
from tributary.session import scratch_path
from tributary.streaming import feeds

from conftest import SF_SMALL


def test_restart_resumes_without_duplicates(spark):
    out, ckpt = scratch_path(spark, "t/out"), scratch_path(spark, "t/ckpt")
    s = feeds.changes_stream(spark, SF_SMALL).select("sequence", "index")
    feeds.run(s, path=out, checkpoint=ckpt)
    first = spark.read.parquet(out).count()
    feeds.run(s, path=out, checkpoint=ckpt)
    assert spark.read.parquet(out).count() == first == changes(spark, SF_SMALL).count()


def test_stream_equals_batch_through_memory_sink(spark):
    s = feeds.changes_stream(spark, SF_SMALL).groupBy("index").agg(F.count(F.lit(1)).alias("n"))
    q = (s.writeStream.outputMode("complete").format("memory").queryName("mem_counts")
         .option("checkpointLocation", scratch_path(spark, "t/mem")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r["index"]: r["n"] for r in spark.sql("SELECT * FROM mem_counts").collect()}
    want = {r["index"]: r["n"] for r in changes(spark, SF_SMALL).groupBy("index").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert got == want


def test_stop_midway_and_restart_exactly_once(spark):
    """Kill-and-restart: a stream stopped after some micro-batches resumes from its
    checkpoint and the file sink holds every change exactly once."""
    src = scratch_path(spark, "t/src")
    c = changes(spark, SF_SMALL)
    c.repartition(6, "sequence").write.parquet(src)        # several files -> several micro-batches
    out, ckpt = scratch_path(spark, "t/out"), scratch_path(spark, "t/ckpt")
    stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(src)

    q = feeds.start(stream, path=out, checkpoint=ckpt, trigger={"processingTime": "100 milliseconds"})
    deadline = time.time() + 60
    while time.time() < deadline and (q.lastProgress is None or q.lastProgress.get("batchId", -1) < 1):
        time.sleep(0.2)
    q.stop()                                                # stopped between micro-batches
    partial = spark.read.parquet(out).count() if spark.read.parquet(out).columns else 0
    feeds.run(stream, path=out, checkpoint=ckpt)            # resume, drain the rest
    got = spark.read.parquet(out)
    assert got.count() == c.count() >= partial
    assert got.select("sequence").distinct().count() == c.count()


def test_a_retried_batch_counts_once(spark):
    """The same micro-batch handed over again replaces what it wrote."""
    out = scratch_path(spark, "t/s7")
    sink = feeds.consume_batch(out, "sequence")
    c = changes(spark, SF_SMALL)
    for batch_id, rest in ((0, 0), (1, 1), (1, 1), (0, 0)):
        sink(c.filter(F.col("sequence") % 2 == rest), batch_id)
    sink(c.limit(0), 2)
    assert spark.read.parquet(out).count() == c.count()
