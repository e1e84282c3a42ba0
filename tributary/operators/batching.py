"""Packing changes into bounded write batches.

A batch belongs to a lane (parallel writer) and, when ticks are used, to a
flush tick of ``tick_ms`` (event time).

* count batches (W1) number rows exactly within a (lane, tick) group, in
  parallel: rows are numbered inside buckets of ``bucket_width`` sequence
  numbers and shifted by the running count of earlier buckets (no single-task
  window);
* byte batches (W2) flush right after the row that reaches a limit.  Where a
  batch ends depends on where it began, so a lane's flush interval is passed
  through in order by one task; the tick bounds it, as it bounds a writer's buffer;
* tick batches (W3) are plain event-time windows.
"""

from __future__ import annotations

from typing import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tributary.functions.envelope import envelope_size
from tributary.session import ship_package

# Default batch limits and flush tick.
DEFAULT_BATCH_SIZE = 1000
DEFAULT_BATCH_BYTES = 5 * 1024 * 1024
DEFAULT_TICK_MS = 100
DEFAULT_BUCKET_WIDTH = 1 << 20


def key_lane(lanes: int, key: Sequence[str] = ("index", "doc_id")) -> Column:
    """Lane by key hash: all changes of one document go through one writer."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(lanes)).cast("int")


def sequence_lane(lanes: int, seq: str = "sequence") -> Column:
    """Lane by sequence: even lanes whatever the key skew (apply orders by sequence)."""
    return F.pmod(F.col(seq), F.lit(lanes)).cast("int")


def tick_of(ts: str = "timestamp", tick_ms: int = DEFAULT_TICK_MS) -> Column:
    """Index of the flush tick an event falls in."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    return F.floor(micros / F.lit(tick_ms * 1000)).cast("bigint")


def _ordered(seq: str, tie: Sequence[str]) -> list[Column]:
    return [F.col(seq)] + [F.col(t) for t in tie]


def batch_by_count(df: DataFrame, size: int = DEFAULT_BATCH_SIZE, lane: Column | None = None,
                   tick_ms: int | None = None, ts: str = "timestamp", seq: str = "sequence",
                   tie: Sequence[str] = ("index", "doc_id"),
                   bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Flush when a batch holds ``size`` changes (and at every tick, if given).

    Adds ``lane``, ``tick`` (NULL without ticks), ``batch_no`` and ``batch_pos``
    (0-based position inside the batch, the item number in a bulk request).

    Positions inside a (lane, tick) group are exact and computed in parallel:
    rows are numbered inside buckets of ``bucket_width`` sequence numbers
    (bounded windows), and each bucket adds the running count of the buckets
    before it (a window over a small table of per-bucket counts).
    """
    lane = F.lit(0) if lane is None else lane
    d = df.withColumn("lane", lane.cast("int"))
    d = d.withColumn("tick", tick_of(ts, tick_ms) if tick_ms is not None else F.lit(None).cast("bigint"))
    d = d.withColumn("_bucket", F.floor(F.col(seq) / F.lit(bucket_width)).cast("bigint"))
    grp = ["lane", "tick"]
    counts = d.groupBy(*grp, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*grp).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*grp, "_bucket", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*grp, "_bucket").orderBy(*_ordered(seq, tie))
    local = d.withColumn("_r", F.row_number().over(w) - 1)
    on = [local["lane"] == offsets["lane"], local["tick"].eqNullSafe(offsets["tick"]),
          local["_bucket"] == offsets["_bucket"]]
    pos = local.join(offsets, on).select(local["*"], (offsets["_off"] + local["_r"]).alias("_p"))
    return (pos.withColumn("batch_no", F.floor(F.col("_p") / size).cast("bigint"))
            .withColumn("batch_pos", (F.col("_p") % size).cast("int"))
            .drop("_p", "_r", "_bucket"))


def flush_points(sizes: np.ndarray, max_bytes: int, max_count: int | None) -> np.ndarray:
    """First rows of the batches: each ends with the row whose running size or count reaches a limit."""
    total = np.cumsum(sizes)
    first, starts = 0, []
    while first < len(sizes):
        starts.append(first)
        before = int(total[first - 1]) if first else 0
        end = int(np.searchsorted(total, before + max_bytes))
        if max_count:
            end = min(end, first + max_count - 1)
        first = end + 1
    return np.array(starts, np.int64)


def _numbered(batches: Iterable[pa.RecordBatch], max_bytes: int, max_count: int | None) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lane, tick) with their batch and their position in it.

    Only the group at hand, its open batch's number, rows and bytes are kept from one
    record batch to the next.  Rows without a lane have no writer: they are never flushed.
    """
    group, no, pos, held = None, 0, 0, 0
    for rows in batches:
        numbers, positions = [], []
        for lane, tick, size in zip(*(rows.column(c).to_pylist() for c in ("lane", "tick", "_size"))):
            if group != (lane, tick):
                group, no, pos, held = (lane, tick), 0, 0, 0
            elif lane is not None and (held >= max_bytes or max_count and pos >= max_count):
                no, pos, held = no + 1, 0, 0
            numbers.append(no)
            positions.append(pos)
            pos, held = pos + 1, held + size
        kept = [c for c in rows.schema.names if c != "_size"]
        yield pa.RecordBatch.from_arrays(
            [*(rows.column(c) for c in kept), pa.array(numbers, pa.int64()), pa.array(positions, pa.int32())],
            names=[*kept, "batch_no", "batch_pos"])


def batch_by_bytes(df: DataFrame, max_bytes: int = DEFAULT_BATCH_BYTES, max_count: int | None = DEFAULT_BATCH_SIZE,
                   lane: Column | None = None, tick_ms: int | None = DEFAULT_TICK_MS, ts: str = "timestamp",
                   seq: str = "sequence", size: Column | None = None,
                   tie: Sequence[str] = ("index", "doc_id")) -> DataFrame:
    """Flush right after the change that makes the batch reach ``max_bytes``
    (or ``max_count`` changes), and at every tick.  A batch may exceed the byte
    limit by one change.

    Adds ``lane``, ``tick``, ``batch_no`` and ``batch_pos``.  Rows of a (lane, tick) are
    taken in order of sequence and ``tie`` (equal sequences are normal: each
    index has its own).  They are shuffled and sorted once and numbered as they
    pass, many groups to a task: no group is collected, and none costs a call.
    """
    ship_package(df.sparkSession)
    size = envelope_size() if size is None else size
    tick = tick_of(ts, tick_ms) if tick_ms is not None else F.lit(None).cast("bigint")
    grp = ["lane", "tick"]
    d = df.withColumn("lane", (F.lit(0) if lane is None else lane).cast("int")).withColumn("tick", tick)
    schema = StructType([*d.schema.fields, StructField("batch_no", LongType()), StructField("batch_pos", IntegerType())])
    rows = d.withColumn("_size", F.coalesce(size.cast("bigint"), F.lit(0)))
    rows = rows.repartition(*grp).sortWithinPartitions(*grp, *_ordered(seq, tie))
    return rows.mapInArrow(lambda batches: _numbered(batches, max_bytes, max_count), schema)


def batch_by_tick(df: DataFrame, tick_ms: int = DEFAULT_TICK_MS, ts: str = "timestamp") -> DataFrame:
    """Every non-empty tick flushes: batch = tick."""
    return df.withColumn("tick", tick_of(ts, tick_ms))


def batch_rollup(batched: DataFrame, by: Sequence[str] = ("lane", "tick", "batch_no"),
                 size: Column | None = None) -> DataFrame:
    """Changes and bytes per batch."""
    size = envelope_size() if size is None else size
    return batched.groupBy(*by).agg(F.count(F.lit(1)).alias("len"), F.sum(size).cast("bigint").alias("size_bytes"))
