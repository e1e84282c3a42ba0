"""A writer's buffer in a stream (W1-W3): state is the open buffer of each lane.

Rows come in sequence order, cut into micro-batches anyhow.  A lane's buffer is
flushed right after the row that reaches ``max_bytes`` or ``max_count``; an event-time
timer at the end of each flush tick flushes what is left of it, whether or not
more rows come.  The batches are those of ``batching.batch_by_bytes`` over the
finished table, however the stream was cut or restarted, since the buffer and
its count of flushed batches are state.  A row is held once, until its batch is
flushed: a lane holds at most a batch per open tick.

What is open when a stream ends stays in the state store; ``open_batches`` reads it
from the checkpoint (the writer's last flush).  ``delay`` is how far event times
may run behind the newest; Spark drops rows behind it, so ``lateness.split_late``
goes first where a feed has such rows.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tributary.functions.envelope import envelope_size
from tributary.operators.batching import DEFAULT_BATCH_BYTES, DEFAULT_BATCH_SIZE, DEFAULT_TICK_MS, flush_points, tick_of
from tributary.session import stateful

_OPEN = "tick bigint, sequence bigint, tie string, size bigint, payload string"
_OUT = "lane int, tick bigint, batch_no bigint, batch_pos int, sequence bigint, payload string, flushed_by string"


class LaneBuffer(StatefulProcessor):
    """The open rows of one lane, and how many batches its open ticks flushed."""

    def __init__(self, max_bytes: int, max_count: int | None, tick_ms: int):
        self.max_bytes, self.max_count, self.tick_ms = max_bytes, max_count, tick_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", _OPEN)
        self.flushed = handle.getMapState("flushed", "tick bigint", "batches bigint")

    def handleInputRows(self, key, rows, timerValues):
        names = ["tick", "sequence", "tie", "size", "payload"]
        held = pd.DataFrame(list(self.open.get()), columns=names)
        waiting = set(held["tick"].tolist())
        new = pd.concat([b[names] for b in rows], ignore_index=True)
        every = pd.concat([held, new], ignore_index=True) if len(held) else new
        every = every.sort_values(["tick", "sequence", "tie"], kind="stable")
        left = []
        for tick, part in every.groupby("tick", sort=True):
            tick = int(tick)
            before = self._before(tick)
            starts = flush_points(part["size"].to_numpy(np.int64), self.max_bytes, self.max_count)
            cut = self._closed_upto(part["size"].to_numpy(np.int64), starts)
            closed = int((starts < cut).sum())
            if cut:
                yield self._batches(key, tick, part.iloc[:cut], starts[:closed], before, "limit")
                self.flushed.updateValue((tick,), (before + closed,))
            if cut < len(part):
                left.append(part.iloc[cut:])
            if tick not in waiting and (cut < len(part) or before == 0):
                self.handle.registerTimer((tick + 1) * self.tick_ms)
        if left:
            self.open.put([tuple(r) for r in pd.concat(left)[names].itertuples(index=False, name=None)])
        else:
            self.open.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        tick = expiredTimerInfo.getExpiryTimeInMs() // self.tick_ms - 1
        held = pd.DataFrame(list(self.open.get()), columns=["tick", "sequence", "tie", "size", "payload"])
        mine = held["tick"] == tick
        if mine.any():
            yield self._batches(key, tick, held[mine], np.zeros(1, np.int64), self._before(tick), "tick")
            rest = held[~mine]
            if len(rest):
                self.open.put([tuple(r) for r in rest.itertuples(index=False, name=None)])
            else:
                self.open.clear()
        if self.flushed.containsKey((tick,)):
            self.flushed.removeKey((tick,))

    def close(self) -> None:
        pass

    def _before(self, tick: int) -> int:
        return self.flushed.getValue((tick,))[0] if self.flushed.containsKey((tick,)) else 0

    def _closed_upto(self, sizes: np.ndarray, starts: np.ndarray) -> int:
        """Rows of closed batches; the last batch is open unless it reached a limit."""
        last = int(starts[-1])
        full = int(sizes[last:].sum()) >= self.max_bytes or bool(self.max_count and len(sizes) - last >= self.max_count)
        return len(sizes) if full else last

    def _batches(self, key, tick: int, part: pd.DataFrame, starts: np.ndarray, before: int, why: str) -> pd.DataFrame:
        at = np.arange(len(part))
        no = np.searchsorted(starts, at, "right") - 1
        return pd.DataFrame({"lane": np.int32(key[0]), "tick": tick, "batch_no": before + no, "batch_pos": (at - starts[no]).astype(np.int32),
                             "sequence": part["sequence"].to_numpy(), "payload": part["payload"].to_numpy(), "flushed_by": why})


def _tie(tie: Sequence[str]) -> Column:
    return F.concat_ws("\x00", *[F.col(c).cast("string") for c in tie])


def batch_stream(stream: DataFrame, payload: Column, lane: Column, max_bytes: int = DEFAULT_BATCH_BYTES,
                 max_count: int | None = DEFAULT_BATCH_SIZE, tick_ms: int = DEFAULT_TICK_MS, size: Column | None = None,
                 delay: str = "0 seconds", ts: str = "timestamp", seq: str = "sequence",
                 tie: Sequence[str] = ("index", "doc_id")) -> DataFrame:
    """Flushed batches of a stream of changes, one row per change: ``lane``, ``tick``, ``batch_no``,
    ``batch_pos``, ``sequence``, ``payload`` and ``flushed_by`` (``limit`` or ``tick``)."""
    stateful(stream.sparkSession)
    rows = stream.select(lane.cast("int").alias("lane"), tick_of(ts, tick_ms).alias("tick"), F.col(seq).alias("sequence"),
                         _tie(tie).alias("tie"), (envelope_size() if size is None else size).cast("bigint").alias("size"),
                         payload.alias("payload"), F.col(ts).cast("timestamp").alias("at"))
    return rows.withWatermark("at", delay).groupBy("lane").transformWithStateInPandas(
        LaneBuffer(max_bytes, max_count, tick_ms), _OUT, "append", "EventTime")


def open_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The rows a stopped stream has not flushed, as the batches they would be (``flushed_by`` is ``end``)."""
    stateful(spark)
    read = lambda name: spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
    held = read("open").select("key.lane", "list_element.*")
    flushed = read("flushed").select("key.lane", F.col("user_map_key.tick").alias("tick"), F.col("user_map_value.batches").alias("batch_no"))
    order = Window.partitionBy("lane", "tick").orderBy("sequence", "tie")      # an open batch each
    return held.join(flushed, ["lane", "tick"], "left").select(
        "lane", "tick", F.coalesce("batch_no", F.lit(0)).cast("bigint").alias("batch_no"),
        (F.row_number().over(order) - 1).cast("int").alias("batch_pos"), "sequence", "payload", F.lit("end").alias("flushed_by"))
