"""Windowed counts that lose no row (T13): late rows go to a side table.

Spark's own watermark drops rows behind it without a word.  Here the state keeps the
clock: per key, the newest event time of the rows before, in order of sequence.
A row whose window ended ``delay`` before that is late: it is told as it is, with its
window and lateness, and counts for no window any more.  Every other row counts,
so counts and late rows are all rows, however the stream is cut in micro-batches.
A window leaves the state when the clock passes its end and the delay.

A hot label is split in ``lanes`` (by sequence), each with its own clock; readers add
up the lanes' counts.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tributary.session import stateful

_OUT = "kind string, window_us bigint, n bigint, sequence bigint, late_us bigint"
COUNT, LATE = "count", "late"


class LateCounter(StatefulProcessor):
    """Open windows and the clock of one key; times in microseconds."""

    def __init__(self, names: Sequence[str], kinds: str, window: int, delay: int):
        self.names, self.kinds, self.window, self.delay = list(names), kinds, window, delay

    def init(self, handle) -> None:
        self.clock = handle.getValueState("clock", "at bigint")
        self.open = handle.getListState("open", "window_us bigint, n bigint")

    def handleInputRows(self, key, rows, timerValues):
        every = pd.concat(list(rows), ignore_index=True).sort_values("sequence", kind="stable")
        at, first = every["at"].to_numpy(np.int64), np.iinfo(np.int64).min
        clock = self.clock.get()[0] if self.clock.exists() else first
        newest = np.maximum.accumulate(np.concatenate([[clock], at]))
        start = at // self.window * self.window
        # a row's lateness is how far the rows before it are past its window's last moment
        behind = np.where(newest[:-1] == first, 0, newest[:-1] - (start + self.window + self.delay))
        late = (newest[:-1] != first) & (behind >= 0)
        self.clock.update((int(newest[-1]),))
        held = {w: n for w, n in self.open.get()}
        changed = {int(w): held.get(int(w), 0) + int(n) for w, n in pd.Series(start[~late]).value_counts().items()}
        left = [(w, n) for w, n in (held | changed).items() if w + self.window + self.delay > newest[-1]]
        if left:
            self.open.put(left)
        else:
            self.open.clear()
        own = dict(zip(self.names, key))
        made = [pd.DataFrame({"kind": COUNT, "window_us": list(changed), "n": list(changed.values()), "sequence": -1, "late_us": -1}),
                pd.DataFrame({"kind": LATE, "window_us": start[late], "n": 1, "sequence": every["sequence"].to_numpy()[late],
                              "late_us": behind[late]})]
        yield pd.concat([m.assign(**own) for m in made if len(m)], ignore_index=True)[
            [*self.names, "kind", "window_us", "n", "sequence", "late_us"]]

    def close(self) -> None:
        pass


def counted(stream: DataFrame, window_ms: int, delay_ms: int, by: Sequence[str] = ("index",), lanes: int = 4,
            ts: str = "timestamp", seq: str = "sequence") -> DataFrame:
    """Update-mode stream of ``kind`` rows per ``by`` and ``lane``: a changed window's count, or a late row."""
    stateful(stream.sparkSession)
    lane: Column = F.pmod(F.col(seq), F.lit(lanes)).cast("int")
    rows = stream.select(*by, lane.alias("lane"), F.col(seq).alias("sequence"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"))
    keys = [*by, "lane"]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys)
    return rows.groupBy(*keys).transformWithStateInPandas(
        LateCounter(keys, kinds, window_ms * 1000, delay_ms * 1000), f"{kinds}, {_OUT}", "update", "None")


def split_sink(counts_path: str, late_path: str):
    """Each micro-batch's counts and late rows, in folders of its id that a retry replaces."""
    def _sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        for kind, path in ((COUNT, counts_path), (LATE, late_path)):
            batch.filter(F.col("kind") == kind).drop("kind").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        batch.unpersist()
    return _sink


def current_counts(counts: DataFrame, by: Sequence[str] = ("index",)) -> DataFrame:
    """Count per window: each lane's latest, added up."""
    last = counts.groupBy(*by, "lane", "window_us").agg(F.max_by("n", "batch_id").alias("n"))
    return last.groupBy(*by, "window_us").agg(F.sum("n").alias("n"))


def late_rows(late: DataFrame) -> DataFrame:
    """The late rows as a table: ``sequence``, window and lateness in microseconds."""
    return late.drop("n", "batch_id")
