"""Incremental reads of a change table by sequence cursor.

A scan is ``filter(sequence > cursor) -> orderBy -> limit``: the range reaches
the parquet scan as ``GreaterThan`` (row groups skipped by statistics) and the
sort + limit runs as ``TakeOrderedAndProject`` (top-k per task, no full sort).
Cursors live per ``(source_id, index)`` in a small table; a poll joins the
change table with it, and adaptive execution broadcasts it when its size in
bytes allows.  A limit never cuts rows that share a sequence: a poll grows to
the whole tie, so the cursor that follows it passes over nothing.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.filters import glob_match

# Fixed value: default fetch size of a poll.
DEFAULT_FETCH_SIZE = 1000

START_CURSOR = -1  # before the first sequence, so sequence 0 is read (the original started at 0)


def index_match(patterns: Sequence[str] | None, index: str = "index") -> Column:
    """Index wildcard patterns (F2 rule), OR-ed; ``None`` or empty = everything."""
    if not patterns:
        return F.lit(True)
    out = None
    for p in patterns:
        m = glob_match(F.col(index), p)
        out = m if out is None else out | m
    return out


def _upto(rows: DataFrame, limit: int | None, seq: str) -> DataFrame:
    """The first ``limit`` rows by sequence, and every other row of the last one's sequence."""
    if limit is None:
        return rows
    last = rows.select(seq).orderBy(seq).limit(limit).select(F.max(seq)).scalar()
    return rows.filter(F.col(seq) <= last)


def scan(df: DataFrame, cursor: int | Column = START_CURSOR, limit: int | None = DEFAULT_FETCH_SIZE,
         patterns: Sequence[str] | None = None, seq: str = "sequence") -> DataFrame:
    """Rows past the cursor in sequence order, about ``limit`` of them.

    The result grows to the whole group of rows sharing the last sequence, so a
    cursor advanced to the maximum never loses a tie cut by the limit.
    ``cursor`` may be any value (seek backwards included).
    """
    c = cursor if isinstance(cursor, Column) else F.lit(cursor)
    return _upto(df.filter(index_match(patterns) & (F.col(seq) > c)), limit, seq)


def poll_union(df: DataFrame, patterns: Sequence[str], cursor: int | Column = START_CURSOR,
               limit: int | None = DEFAULT_FETCH_SIZE, seq: str = "sequence") -> DataFrame:
    """S3: one scan per pattern from the same cursor, appended (a row matching two
    patterns appears twice)."""
    parts = [scan(df, cursor, limit, [p], seq).withColumn("pattern", F.lit(p)) for p in patterns]
    return reduce(DataFrame.unionByName, parts)


def next_cursor(polled: DataFrame, seq: str = "sequence", by: Sequence[str] = ()) -> DataFrame:
    """A1: the cursor after a poll is the highest sequence returned."""
    agg = F.max(seq).alias("cursor")
    return polled.groupBy(*by).agg(agg) if by else polled.agg(agg)


def poll_per_index(df: DataFrame, cursors: DataFrame, patterns: Sequence[str] | None = None,
                   limit: int | None = DEFAULT_FETCH_SIZE, seq: str = "sequence",
                   keys: Sequence[str] = ("index",)) -> DataFrame:
    """One scan over all patterns with a cursor per key (default per index).

    Keys without a cursor row start before the first sequence.
    """
    rows = df.filter(index_match(patterns)).join(cursors.select(*keys, F.col("cursor")), list(keys), "left")
    rows = rows.filter(F.col(seq) > F.coalesce(F.col("cursor"), F.lit(START_CURSOR))).drop("cursor")
    return _upto(rows, limit, seq)


def point_lookup(df: DataFrame, index: str, doc_id: str) -> DataFrame:
    """One document by key (pushed to the scan as two equalities)."""
    return df.filter((F.col("index") == index) & (F.col("doc_id") == doc_id))


def multi_get(df: DataFrame, keys: DataFrame, on: Sequence[str] = ("index", "doc_id")) -> DataFrame:
    """Many lookups at once as a semi join."""
    return df.join(keys.select(*on), list(on), "left_semi")


def retention(df: DataFrame, hours: int = 24, ts: str = "timestamp") -> DataFrame:
    """K3: keep what is younger than ``hours`` relative to the newest row."""
    newest = df.select(F.max(ts)).scalar()
    return df.filter(F.col(ts) > newest - F.make_interval(hours=F.lit(hours)))
