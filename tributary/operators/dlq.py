"""Dead-letter handling.

The DLQ is a table: envelope columns + ``error``, ``error_kind``,
``failed_at`` and ``attempts``.  Failures are matched back to the envelopes of
their batch by position (exact) or by key with the earliest sequence;
appends go through the file sink, bounding and peeking are top-k queries,
and a replay re-runs the failed changes and keeps what fails again.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.errors import is_transient

# Fixed value: default DLQ capacity.
DEFAULT_MAX_SIZE = 100_000
SCHEMA = ("sequence bigint, timestamp timestamp, operation string, index string, doc_id string, source string, "
          "error string, error_kind string, failed_at timestamp, attempts int")
ENVELOPE_COLUMNS = ("sequence", "timestamp", "operation", "index", "doc_id", "source")


def match_failures(failures: DataFrame, batch: DataFrame, by: Sequence[str],
                   on_position: bool = True, key: Sequence[str] = ("index", "doc_id")) -> DataFrame:
    """Failures -> the envelopes they belong to.

    ``on_position``: join on the batch and the item position (responses keep
    request order), exact.  Otherwise join on the batch and the key and take
    the earliest sequence per failure.  Both sides are bounded per batch.
    """
    by = list(by)
    if on_position:
        f = failures.select(*by, F.col("item_no").alias("batch_pos"), "error_type", "error_reason")
        return batch.join(f, by + ["batch_pos"], "inner")
    f = failures.select(*by, "item_no", *key, "error_type", "error_reason")
    j = batch.join(f, by + list(key), "inner")
    env = F.struct(*[F.col(c) for c in batch.columns if c not in by + list(key)])
    # one row per failure (its position identifies it); first envelope of that key wins
    first = j.groupBy(*by, "item_no", *key, "error_type", "error_reason").agg(
        F.min_by(env, F.col("sequence")).alias("e"))
    return first.select(*by, *key, "error_type", "error_reason", "e.*")


def dlq_entries(matched: DataFrame, error: Column, error_kind: Column | None = None,
                failed_at: Column | None = None, attempts: Column | int = 1) -> DataFrame:
    """DLQ rows (envelope + error, kind, failure time, attempt count)."""
    kind = error_kind if error_kind is not None else F.lit(None).cast("string")
    at = failed_at if failed_at is not None else F.current_timestamp()
    att = attempts if isinstance(attempts, Column) else F.lit(attempts)
    return matched.select(*ENVELOPE_COLUMNS, error.alias("error"), kind.alias("error_kind"),
                          at.alias("failed_at"), att.cast("int").alias("attempts"))


def append(entries: DataFrame, path: str) -> None:
    """Durable append (each write is atomic through the file commit protocol)."""
    entries.write.mode("append").parquet(path)


def bound(dlq: DataFrame, max_size: int = DEFAULT_MAX_SIZE) -> DataFrame:
    """Keep the newest ``max_size`` entries (top-k, no global window)."""
    return dlq.orderBy(F.col("failed_at").desc(), F.col("sequence").desc()).limit(max_size)


def peek(dlq: DataFrame, n: int) -> DataFrame:
    """O3: the first ``n`` entries in arrival order, not removed."""
    return dlq.orderBy(F.col("failed_at"), F.col("sequence")).limit(n)


def replay(dlq: DataFrame, succeeds: Callable[[], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Drain the DLQ: (changes to apply again, entries that fail again).

    ``succeeds`` decides per entry whether the retry works; by default
    transient errors clear and the others fail again.  Failing entries come
    back with ``attempts + 1``; the caller overwrites the DLQ with them.
    """
    ok = succeeds() if succeeds is not None else is_transient("error_kind")
    d = dlq.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    retried = d.filter("_ok").select(*ENVELOPE_COLUMNS)
    again = d.filter(~F.col("_ok")).drop("_ok").withColumn("attempts", F.col("attempts") + 1)
    return retried, again
