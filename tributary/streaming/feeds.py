"""Structured Streaming forms of the sources, sinks and stateful operators.

Every operator in the engine is a DataFrame transformation, so the streaming
job is the batch job on ``readStream``.  What is specific to streams lives
here: the file source with a rate limit (S6, T8), micro-batch sinks through
``foreachBatch`` (S7, K2, K5, F25), restart from the checkpoint (T1, T14),
watermarked de-duplication (T7) and windowed metrics (T13).

Checkpoints and outputs go under the shared folder named by
``spark.checkpoint.dir``; a restarted query resumes from its offsets and
commits, and a micro-batch id makes sink writes idempotent.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.fixtures import changes_from_events
from tributary.functions import envelope as env
from tributary.session import scratch_path
from tributary.sources.tables import read_table

# Fixed value: de-duplication horizon, the log's retention.
DEDUPE_HORIZON = "24 hours"


def read_table_stream(spark: SparkSession, sf_dir: str, name: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver table as a file stream (schema taken from the batch scan)."""
    schema = read_table(spark, sf_dir, name).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(sf_dir)


def changes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes_from_events(read_table_stream(spark, sf_dir, "events"))


def start(df: DataFrame, *, path: str | None = None, checkpoint: str | None = None,
          foreach_batch: Callable[[DataFrame, int], None] | None = None, output_mode: str = "append",
          partition_by: tuple = (), trigger: dict | None = None, name: str = "stream") -> StreamingQuery:
    """Start a query with a checkpoint in the shared folder (``availableNow`` by default)."""
    spark = df.sparkSession
    checkpoint = checkpoint or scratch_path(spark, f"checkpoints/{name}")
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
        return w.start()
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.format("parquet").start(path)


def run(df: DataFrame, **kw) -> StreamingQuery:
    """Start and drain (T14: ``availableNow`` stops after the last micro-batch)."""
    q = start(df, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def dedupe(stream: DataFrame, key: str = "msg_id", ts: str = "timestamp",
           horizon: str = DEDUPE_HORIZON) -> DataFrame:
    """Drop redeliveries; state kept only for ``horizon`` of event time."""
    s = stream.withColumn("_wm_ts", F.col(ts).cast("timestamp"))
    return s.withWatermark("_wm_ts", horizon).dropDuplicatesWithinWatermark([key]).drop("_wm_ts")


def windowed_counts(stream: DataFrame, window: str, by: tuple = ("index",), ts: str = "timestamp",
                    delay: str = "1 hour") -> DataFrame:
    """Live counters per event-time window and labels."""
    s = stream.withColumn("_wm_ts", F.col(ts).cast("timestamp")).withWatermark("_wm_ts", delay)
    g = s.groupBy(F.window("_wm_ts", window).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *by, "n")


def _write_batch(df: DataFrame, path: str, batch_id: int, *partitions: str) -> None:
    """Write one micro-batch in a folder of its own; a retry of the same id replaces it."""
    df.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/batch_id={batch_id}")


def consume_batch(path: str, *columns: str):
    """A batch consumer; hands on non-empty batches, each in the folder of its id."""
    def _sink(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            _write_batch(batch.select(*columns), path, batch_id)
    return _sink


def publish_batch(log_path: str, counts_path: str | None = None, tenant: str = "default"):
    """K2 / K5: one micro-batch = one folder per sink, named by its batch id.

    A retried id replaces its folders, so it never counts twice.  The counts are
    read from what was published.
    """
    def _sink(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch.withColumn("subject", env.subject(tenant)), log_path, batch_id, "index")
        if counts_path:
            published = batch.sparkSession.read.parquet(f"{log_path}/batch_id={batch_id}")
            _write_batch(published.groupBy("index").agg(F.count(F.lit(1)).alias("published")), counts_path, batch_id)
    return _sink


def gate_with_reloaded_spec(spec_reader: Callable[[], dict], out_path: str):
    """the filter spec is read again at the start of every micro-batch of a running stream."""
    from tributary.operators import filters as flt

    def _sink(batch: DataFrame, batch_id: int) -> None:
        spec = spec_reader()
        chain = flt.chain_from_spec(spec)
        _write_batch(batch.filter(chain.passes()).withColumn("spec_version", F.lit(spec.get("version", 0))),
                     out_path, batch_id)
    return _sink


def append_updates(path: str):
    """Sink for update-mode aggregates: the changed rows of a batch, in the batch's folder."""
    def _sink(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, path, batch_id)
    return _sink


def latest_updates(updates: DataFrame, key: tuple) -> DataFrame:
    """Current value per key of an update-mode sink (the row of the latest batch)."""
    vals = [c for c in updates.columns if c not in key and c != "batch_id"]
    last = F.max_by(F.struct(*vals), "batch_id").alias("_v")
    return updates.groupBy(*key).agg(last).select(*key, *[F.col(f"_v.{c}").alias(c) for c in vals])
