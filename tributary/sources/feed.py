"""Source objects (X3, X4): one place that knows how to read a change table
as a batch from a cursor, as a stream, and what is still pending."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.sources import cursor as cur


@dataclass
class ChangeSource:
    """``read_batch`` (S1 / T5 from any cursor), ``read_stream`` (S6),
    ``pending`` (A17) and ``unacked`` (J3)."""

    batch: Callable[[SparkSession], DataFrame]
    stream: Callable[[SparkSession], DataFrame] | None = None
    patterns: Sequence[str] | None = None

    def read_batch(self, spark: SparkSession, cursor: int = cur.START_CURSOR,
                   limit: int | None = cur.DEFAULT_FETCH_SIZE) -> DataFrame:
        return cur.scan(self.batch(spark), cursor, limit, self.patterns)

    def read_stream(self, spark: SparkSession) -> DataFrame:
        if self.stream is None:
            raise ValueError("this source has no stream form")
        return self.stream(spark).filter(cur.index_match(self.patterns))

    def pending(self, spark: SparkSession, cursor: int) -> DataFrame:
        return self.batch(spark).filter(cur.index_match(self.patterns) & (F.col("sequence") > cursor)).agg(
            F.count(F.lit(1)).alias("pending"))


def unacked(delivered: DataFrame, acked: DataFrame, key: str = "msg_id") -> DataFrame:
    """Delivered but never acknowledged (to be delivered again), with the
    number of deliveries; the acked side is reduced to distinct ids first."""
    d = delivered.groupBy(key).agg(F.count(F.lit(1)).alias("deliveries"), F.min("sequence").alias("sequence"))
    return d.join(acked.select(key).distinct(), key, "left_anti")


def nacked(delivered: DataFrame, nacks: DataFrame, key: str = "msg_id") -> DataFrame:
    """Deliveries that were explicitly refused (asked for again)."""
    return delivered.join(nacks.select(key).distinct(), key, "left_semi")
