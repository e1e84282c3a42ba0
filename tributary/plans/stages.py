"""The three replication stages, chained by tables in batches.

* watch (T9): changes past the per-index cursors -> envelopes -> a batch of the
  published log -> cursor commit (T4), taken from what was published;
* gate (T10): every new batch of the log -> decode -> filter chain -> transform
  -> one batch that holds forwarded messages, quarantined payloads (T6) and
  the filtered ones' numbers, by outcome;
* write (T11): every new gated batch -> dedupe by message id -> bulk batches by
  count, bytes and tick -> keyed apply -> DLQ for changes the store cannot
  take -> write results.

A stage reads the batches of the stage before that it has not finished, and
writes each in a folder named by the batch.  A batch that failed half way is
written again in the same folder (the table skips a batch id it holds), so
running a stage again adds nothing twice, and nothing is read from the start
again.  All paths of a batch are bounded by ``SyncConfig.fetch``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions import codec
from tributary.functions import envelope as env
from tributary.functions import errors as err
from tributary.operators import batching as bt
from tributary.operators import dlq as dq
from tributary.operators import filters as flt
from tributary.operators.apply import KeyedTable
from tributary.operators.transform import apply_transform
from tributary.session import materialize, release, scratch_path
from tributary.sinks import bulk
from tributary.sources import cursor as cur
from tributary.sources import storage

OUTCOMES = ("forwarded", "filtered", "quarantined")
#: Optional envelope fields; a feed may have any of them.
OPTIONAL = ("doc_type", "version", "primary_term", "correlation_id", "headers", "routing", "pipeline")


@dataclass
class SyncConfig:
    tenant: str = "default"
    source_id: str = "store"
    patterns: tuple = ()
    chain: flt.FilterChain = field(default_factory=flt.FilterChain)
    transform: Callable[[DataFrame], DataFrame] | None = None
    downstream_prefix: str = "sync"
    fetch: int | None = None                  # changes per batch; None = all there are
    batch_size: int = bt.DEFAULT_BATCH_SIZE
    batch_bytes: int = bt.DEFAULT_BATCH_BYTES
    tick_ms: int = bt.DEFAULT_TICK_MS
    lanes: int = 4
    # sends bulk requests to a store: (lane, tick, batch_no, body) -> the same keys and the response bodies
    send: Callable[[DataFrame], DataFrame] | None = None
    max_attempts: int = err.MAX_ATTEMPTS


@dataclass
class SyncPaths:
    log: str
    cursors: str
    gated: str
    dlq: str
    results: str
    target: str

    @classmethod
    def fresh(cls, spark: SparkSession) -> "SyncPaths":
        root = scratch_path(spark, "sync")
        return cls(*(f"{root}/{n}" for n in ("log", "cursors", "gated", "dlq", "results", "target")))


def _batches(spark: SparkSession, path: str) -> list[str]:
    """Finished batches of a stage, oldest first."""
    return [n for n in storage.names(spark, path) if storage.done(spark, f"{path}/{n}")]


def _write(df: DataFrame, path: str, batch: str, *partitions: str) -> DataFrame:
    df.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/{batch}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{batch}")


#: What the stages write, so that batches without rows read like the others.
SCHEMAS = {
    "log": "subject string, payload string, sequence bigint, operation string, index string, batch string",
    "cursors": "index string, cursor bigint, batch string",
    "gated": "subject string, payload string, reason string, msg_id string, sequence bigint, outcome string, "
             "index string, batch string",
    "dlq": f"{dq.SCHEMA}, batch string",
    "results": "lane int, tick bigint, batch_no bigint, success_count bigint, failure_count bigint, size_bytes bigint, "
               "batch string",
}


def _read(spark: SparkSession, path: str) -> DataFrame:
    """All finished batches of a stage."""
    schema, batches = SCHEMAS[path.rsplit("/", 1)[-1]], _batches(spark, path)
    if not batches:
        return spark.createDataFrame([], schema).limit(0)      # the planner sees that it is empty
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{b}" for b in batches])


def _read_batch(spark: SparkSession, path: str, batch: str) -> DataFrame:
    schema = SCHEMAS[path.rsplit("/", 1)[-1]]
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{batch}")


def _cursors(spark: SparkSession, paths: "SyncPaths") -> DataFrame:
    return _read(spark, paths.cursors).groupBy("index").agg(F.max("cursor").alias("cursor"))


def _encode(df: DataFrame):
    return codec.encode(**{c: c for c in OPTIONAL if c in df.columns})


def watch(spark: SparkSession, feed: DataFrame, paths: SyncPaths, cfg: SyncConfig) -> DataFrame:
    """Poll past the cursors, publish envelopes, then commit the cursors.  Returns the log."""
    known = _batches(spark, paths.cursors)
    polled = cur.poll_per_index(feed, _cursors(spark, paths), cfg.patterns or None, limit=cfg.fetch)
    out = polled.withColumn("source_id", F.lit(cfg.source_id)).withColumn("msg_id", env.message_id())
    batch = f"batch={len(known):08d}"
    published = _write(out.select(env.subject(cfg.tenant).alias("subject"), _encode(out).alias("payload"),
                                  "index", "sequence", "operation"), paths.log, batch, "index")           # K1
    _write(published.groupBy("index").agg(F.max("sequence").alias("cursor")), paths.cursors, batch)        # T4
    return _read(spark, paths.log)


def gate_stage(spark: SparkSession, paths: SyncPaths, cfg: SyncConfig) -> DataFrame:
    """Decode, quarantine, gate, transform, forward what is new.  Returns the counts so far."""
    done = set(_batches(spark, paths.gated))
    for batch in _batches(spark, paths.cursors):          # a batch counts once its cursors are committed
        if batch in done:
            continue
        decoded = codec.decode(_read_batch(spark, paths.log, batch).select("payload"))
        bad = F.col("reason").isNotNull()
        gated = flt.gate(decoded, cfg.chain).withColumn(
            "outcome", F.when(bad, "quarantined").when(F.col("passed"), "forwarded").otherwise("filtered"))
        gated = gated.drop("decision", "passed", "rejected_by").withColumnRenamed("payload", "_wire")
        gated = apply_transform(gated, cfg.transform)
        forwarded = F.col("outcome") == "forwarded"
        out = gated.select(
            "outcome", F.when(forwarded, env.forward_subject(cfg.downstream_prefix)).alias("subject"),
            F.when(forwarded, _encode(gated)).when(bad, F.col("_wire")).alias("payload"),
            "reason", "msg_id", "sequence", "index")
        _write(out, paths.gated, batch, "outcome", "index")                                               # K4, T6
    c = {k: F.count_if(F.col("outcome") == k).alias(k) for k in ("quarantined", "filtered", "forwarded")}
    return _read(spark, paths.gated).agg(F.count(F.lit(1)).alias("received"), *c.values())


BULK = ("lane", "tick", "batch_no")


def _checked(batched: DataFrame) -> DataFrame:
    """Outcome of each change where no store is asked: a body is required but missing or not JSON."""
    bad = env.body_missing() | (F.col("source").isNotNull() & F.try_parse_json("source").isNull())
    return batched.withColumns({
        "outcome": F.when(bad, "fail").otherwise("success"), "attempts": F.lit(1),
        "error": F.when(bad, "document has no valid body"), "error_kind": F.when(bad, "Serialization")})


def _sent(batched: DataFrame, cfg: SyncConfig) -> list[DataFrame]:
    """Outcome of each change by the store's answers.

    Requests are sent batch by batch, answers matched by position (J1), and what
    the store could not take just now (P17) goes out again, up to
    ``max_attempts`` times.
    """
    order = Window.partitionBy(*BULK).orderBy("batch_pos")
    settled, todo = [], batched
    for attempt in range(1, cfg.max_attempts + 1):
        # a whole batch has its positions already, what is left of one is numbered anew
        todo = todo.withColumn("_pos", F.col("batch_pos") if attempt == 1 else F.row_number().over(order) - 1)
        items = bulk.parse_response(cfg.send(bulk.batch_bodies(todo, by=BULK, pos="_pos")), keep=BULK).select(
            *[F.col(c).alias(f"_{c}") for c in BULK], "item_no", "status", "error_type", "error_reason")
        match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in BULK] + [F.col("_pos") == F.col("item_no")]
        answered = todo.join(items, match, "left").withColumns({
            # a request without an answer is tried again like a failing store
            "outcome": err.request_class(F.coalesce("status", F.lit(503)), F.lit(attempt), cfg.max_attempts),
            "attempts": F.lit(attempt), "error": F.coalesce("error_reason", F.lit("no answer")),
            "error_kind": F.coalesce("error_type", F.lit("Timeout"))})
        settled.append(materialize(answered.select(*batched.columns, "outcome", "attempts", "error", "error_kind"),
                                   "stage/sent"))
        todo = settled[-1].filter(F.col("outcome") == "retry").select(*batched.columns)
        if not todo.limit(1).count():
            break
    return settled


def write_stage(spark: SparkSession, paths: SyncPaths, cfg: SyncConfig) -> DataFrame:
    """Dedupe, batch, send, apply, DLQ for what is new.  Returns all write results per bulk batch."""
    done, table = set(_batches(spark, paths.results)), KeyedTable(spark, paths.target)
    for batch in _batches(spark, paths.gated):
        if batch in done:
            continue
        new = _read_batch(spark, paths.gated, batch).filter(F.col("outcome") == "forwarded").select("payload")
        msgs = codec.valid(codec.decode(new)).dropDuplicates(["msg_id"]).select(*dq.ENVELOPE_COLUMNS)      # T7
        batched = bt.batch_by_bytes(msgs, cfg.batch_bytes, cfg.batch_size, bt.key_lane(cfg.lanes), cfg.tick_ms)
        if cfg.send is None:
            copies = [materialize(_checked(batched), "stage/checked")]
        else:
            first = materialize(batched, "stage/batched")
            copies = [*_sent(first, cfg), first]
        settled = reduce(DataFrame.unionByName, copies if cfg.send is None else copies[:-1]).filter(
            F.col("outcome") != "retry")
        ok = F.col("outcome") == "success"
        _write(dq.dlq_entries(settled.filter(~ok), F.col("error"), F.col("error_kind"), F.col("timestamp"),
                              F.col("attempts")), paths.dlq, batch)                                        # K11
        table.apply(settled.filter(ok), batch)
        _write(settled.groupBy(*BULK).agg(
            F.count_if(ok).alias("success_count"), F.count_if(~ok).alias("failure_count"),
            F.sum(env.envelope_size()).cast("bigint").alias("size_bytes")), paths.results, batch)
        release(*copies)
    return _read(spark, paths.results)


def sync(spark: SparkSession, feed: DataFrame, cfg: SyncConfig, paths: SyncPaths | None = None) -> KeyedTable:
    """Watch -> gate -> write, chained by tables."""
    paths = paths or SyncPaths.fresh(spark)
    watch(spark, feed, paths, cfg)
    gate_stage(spark, paths, cfg)
    write_stage(spark, paths, cfg)
    return KeyedTable(spark, paths.target)


def drain_dlq(spark: SparkSession, paths: SyncPaths, succeeds: Callable[[], object] | None = None) -> DataFrame:
    """Apply what succeeds when tried again; the DLQ keeps the rest, with one more attempt.

    Returns the entries left.  The table is written first: a run that fails in
    between applies the same changes again, which changes nothing.
    """
    batches = _batches(spark, paths.dlq)
    if not batches:
        return _read(spark, paths.dlq)
    retried, again = dq.replay(_read(spark, paths.dlq).drop("batch"), succeeds)
    KeyedTable(spark, paths.target).apply(retried)
    left = materialize(again, "stage/dlq")
    for b in batches[:-1]:
        storage.delete(spark, f"{paths.dlq}/{b}")
    kept = _write(left, paths.dlq, batches[-1])
    release(left)
    return kept


def sync_fused(spark: SparkSession, feed: DataFrame, cfg: SyncConfig, paths: SyncPaths | None = None) -> KeyedTable:
    """A shorter form of T12 without a published log: poll -> gate -> transform -> keyed apply -> cursors.

    It skips the envelope, quarantine, bulk batches and write results, so it is an
    option for a feed and a table on the same cluster, not the measure of T12.
    """
    paths = paths or SyncPaths.fresh(spark)
    known = _batches(spark, paths.cursors)
    polled = materialize(cur.poll_per_index(feed, _cursors(spark, paths), cfg.patterns or None, limit=cfg.fetch),
                         "stage/polled")
    bad = env.body_missing() | (F.col("source").isNotNull() & F.try_parse_json("source").isNull())
    checked = apply_transform(polled.filter(cfg.chain.passes()), cfg.transform).withColumn("_bad", bad)
    batch = f"batch={len(known):08d}"
    _write(dq.dlq_entries(checked.filter("_bad"), F.lit("document has no valid body"), F.lit("Serialization"),
                          F.col("timestamp")), paths.dlq, batch)                                           # K11
    table = KeyedTable(spark, paths.target)
    table.apply(checked.filter(~F.col("_bad")), batch)
    # every polled row counts for the cursor, filtered ones included
    _write(polled.groupBy("index").agg(F.max("sequence").alias("cursor")), paths.cursors, batch)
    release(polled)
    return table
