"""Byte batches of a whole lane, cut in parallel (W2 without flush ticks).

Where a greedy batch ends depends on where it began, so a lane looks sequential.
But every row, taken as the start of a batch, has one next start.  Rows get their
number and byte offset from bucket sums; a lane is cut in chunks of ``chunk_bytes``.
A chunk works out, for the few rows that can be the first start in it, the first
start beyond it: a hop.  Hops are composed by pointer doubling, which marks the
starts that the lane's first row leads to, twice as many chunks a round; then
every chunk lists its own batches from its marked start.  A batch that begins in a
chunk is decided by rows that begin in it or less than ``max_bytes`` behind it, so a
chunk sees the first rows of the next one and no task holds a lane.

Windows over a lane run on one row per bucket or chunk only.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.envelope import envelope_size
from tributary.operators.batching import DEFAULT_BATCH_BYTES, DEFAULT_BATCH_SIZE, DEFAULT_BUCKET_WIDTH
from tributary.session import materialize, release, ship_package

#: A chunk is so many full batches long.
CHUNK_BATCHES = 64
_GROUP = ["lane", "_chunk"]


def next_starts(begin: np.ndarray, size: np.ndarray, max_bytes: int, max_count: int | None) -> np.ndarray:
    """For each row as a batch's start: the position of the next start, ``len(begin) + 1`` where the batch stays open."""
    end = begin + size
    last = np.searchsorted(end, begin + max_bytes, "left")
    if max_count:
        last = np.minimum(last, np.arange(len(begin)) + max_count - 1)
    return np.where(last < len(begin), last + 1, len(begin) + 1)


def numbered(df: DataFrame, lane: Column, seq: str, size: Column, tie: Sequence[str], bucket_width: int) -> DataFrame:
    """``lane``, row number ``_row`` and byte offset ``_begin`` in the lane, from running sums of buckets."""
    d = df.withColumns({"lane": lane.cast("int"), "_size": F.coalesce(size.cast("bigint"), F.lit(0)),
                        "_bucket": F.floor(F.col(seq) / F.lit(bucket_width)).cast("bigint")})
    sums = d.groupBy("lane", "_bucket").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_b"))
    before = Window.partitionBy("lane").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("lane", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_row0"),
                          F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_byte0"))
    own = Window.partitionBy("lane", "_bucket").orderBy(F.col(seq), *[F.col(t) for t in tie])
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumns({"_r": F.row_number().over(own) - 1, "_e": F.sum("_size").over(upto)})
    return d.join(offsets, ["lane", "_bucket"]).withColumns({
        "_row": (F.col("_row0") + F.col("_r")).cast("bigint"),
        "_begin": F.col("_byte0") + F.col("_e") - F.col("_size")}).drop("_bucket", "_r", "_e", "_row0", "_byte0")


def _chunks(rows: DataFrame, max_bytes: int) -> DataFrame:
    """Rows by chunk, and the first rows of each chunk also in the one before."""
    halo = rows.filter((F.col("_chunk") > 0) & (F.col("_begin") < F.col("_low") + max_bytes)).withColumns(
        {"_chunk": F.col("_chunk") - 1, "_own": F.lit(False)})
    return rows.withColumn("_own", F.lit(True)).unionByName(halo)


def _hops(pdf: pd.DataFrame, max_bytes: int, max_count: int | None, width: int) -> pd.DataFrame:
    """The rows that can be a chunk's first start, with the first start beyond the chunk (-1: none)."""
    pdf = pdf.sort_values("_row")
    own, begin, size = int(pdf["_own"].sum()), pdf["_begin"].to_numpy(np.int64), pdf["_size"].to_numpy(np.int64)
    if not own:
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("lane", "entry", "to", "to_chunk")})
    nxt = next_starts(begin, size, max_bytes, max_count)
    last = np.where(nxt[:own] < own, nxt[:own], np.arange(own))           # the next start within the chunk
    while not (last[last] == last).all():
        last = last[last]
    first = np.concatenate([[True], begin[:own - 1] < int(pdf["_low"].iloc[0]) + max_bytes])
    if max_count:
        first &= np.arange(own) < max_count
    entry = np.flatnonzero(first)
    to = nxt[last[entry]]
    at = (begin + size)[np.minimum(to, len(begin)) - 1]                  # where the next start begins
    # the batch stays open, or ends with the lane: a next row that begins in this chunk would be here
    open_ = (to > len(begin)) | ((to == own) & (at // width == pdf["_chunk"].iloc[0]))
    row0 = int(pdf["_row"].iloc[0])
    return pd.DataFrame({"lane": pdf["lane"].iloc[0], "entry": row0 + entry, "to": np.where(open_, -1, row0 + to),
                         "to_chunk": np.where(open_, -1, at // width)})


def _starts(pdf: pd.DataFrame, max_bytes: int, max_count: int | None) -> pd.DataFrame:
    """A chunk's own rows with their batch's number and first row, as far as it begins in the chunk."""
    pdf = pdf.sort_values("_row")
    own, row = int(pdf["_own"].sum()), pdf["_row"].to_numpy(np.int64)
    nxt = next_starts(pdf["_begin"].to_numpy(np.int64), pdf["_size"].to_numpy(np.int64), max_bytes, max_count)
    starts, entry = [], pdf["_entry"].iloc[0]
    at = own if pd.isna(entry) else int(entry) - int(row[0])
    while at < own:
        starts.append(at)
        at = int(nxt[at])
    starts = np.array(starts, np.int64)
    no = np.searchsorted(starts, np.arange(own), "right") - 1
    first = np.full(own, -1, np.int64)
    first[no >= 0] = row[starts[no[no >= 0]]]
    return pd.DataFrame({"lane": pdf["lane"].iloc[0], "_chunk": pdf["_chunk"].iloc[0], "_row": row[:own], "_no": no, "_first": first})


def _reached(hops: DataFrame) -> DataFrame:
    """First starts per chunk that a lane's first row leads to, by pointer doubling."""
    reach = materialize(hops.filter("entry = 0").select("lane", "entry", F.lit(0).cast("bigint").alias("_chunk")), "stage/reach")
    while True:
        new = reach.join(hops, ["lane", "entry"]).filter("to >= 0").select(
            "lane", F.col("to").alias("entry"), F.col("to_chunk").alias("_chunk"))
        more = materialize(reach.unionByName(new), "stage/reach")
        grew = more.count() > reach.count()
        release(reach)
        reach = more
        if not grew:
            release(hops)
            return reach
        then = hops.select("lane", F.col("entry").alias("to"), F.col("to").alias("_to"), F.col("to_chunk").alias("_to_chunk"))
        nxt = materialize(hops.join(then, ["lane", "to"]).filter("_to >= 0").select(
            "lane", "entry", F.col("_to").alias("to"), F.col("_to_chunk").alias("to_chunk")), "stage/hops")
        release(hops)
        hops = nxt


def batch_lanes_by_bytes(df: DataFrame, max_bytes: int = DEFAULT_BATCH_BYTES, max_count: int | None = DEFAULT_BATCH_SIZE,
                         lane: Column | None = None, seq: str = "sequence", size: Column | None = None,
                         tie: Sequence[str] = ("index", "doc_id"), chunk_bytes: int | None = None,
                         bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """W2 without ticks: flush right after the change that makes a batch reach ``max_bytes`` or ``max_count``.

    Adds ``lane``, ``batch_no`` and ``batch_pos``, as ``batch_by_bytes`` does for a lane of one tick.
    """
    ship_package(df.sparkSession)
    width = max(chunk_bytes or CHUNK_BATCHES * max_bytes, max_bytes)
    d = numbered(df, F.lit(0) if lane is None else lane, seq, envelope_size() if size is None else size, tie, bucket_width)
    chunk = F.floor(F.col("_begin") / F.lit(width)).cast("bigint")
    rows = materialize(d.select("lane", chunk.alias("_chunk"), "_row", "_begin", "_size", (chunk * width).alias("_low")), "stage/cut-rows")
    by_chunk = _chunks(rows, max_bytes)
    hops = materialize(by_chunk.groupBy(*_GROUP).applyInPandas(
        lambda pdf: _hops(pdf, max_bytes, max_count, width), "lane int, entry bigint, to bigint, to_chunk bigint"), "stage/hops")
    entries = _reached(hops)
    met = by_chunk.join(entries.withColumnRenamed("entry", "_entry"), _GROUP, "left")
    cut = materialize(met.groupBy(*_GROUP).applyInPandas(
        lambda pdf: _starts(pdf, max_bytes, max_count), "lane int, _chunk bigint, _row bigint, _no bigint, _first bigint"), "stage/cut")
    release(rows, entries)
    own = cut.groupBy(*_GROUP).agg((F.max("_no") + 1).alias("_n"), F.max("_first").alias("_last"))
    before = Window.partitionBy("lane").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = own.select(*_GROUP, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), F.max("_last").over(before).alias("_prev"))
    placed = cut.join(base, _GROUP).select(
        "lane", "_row", (F.col("_base") + F.col("_no")).alias("batch_no"),
        (F.col("_row") - F.when(F.col("_first") >= 0, F.col("_first")).otherwise(F.col("_prev"))).cast("int").alias("batch_pos"))
    return d.join(placed, ["lane", "_row"]).drop("_row", "_begin", "_size")
