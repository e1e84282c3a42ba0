"""Pipeline metrics as aggregations over change / attempt tables.

Counters become ``groupBy(...).agg`` with partial (map-side) aggregation, so a
hot label value costs one row per task before the shuffle.  Gauges are "last
value wins", i.e. ``max_by(value, time)``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Latency histogram bucket bounds in seconds (the exporter's defaults).
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
# Error classes.
RETRYABLE_ERRORS = ("Elasticsearch", "Nats", "Backpressure", "Timeout")
TRANSIENT_ERRORS = ("Backpressure", "Timeout", "ResourceExhausted")


def _n() -> Column:
    return F.count(F.lit(1))


def max_sequence(df: DataFrame, by: Sequence[str] = (), seq: str = "sequence") -> DataFrame:
    """A1: the next cursor is the highest sequence seen (per group if given)."""
    agg = F.max(seq).alias("max_sequence")
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def changes_total(df: DataFrame, component: str) -> DataFrame:
    """A2: change counter by component, index, operation."""
    return (df.groupBy(F.lit(component).alias("component"), "index", "operation")
            .agg(_n().alias("changes")))


def errors_total(df: DataFrame, component: str, error_col: str = "error_kind") -> DataFrame:
    """A3: error counter by component and error type (rows with an error only)."""
    return (df.filter(F.col(error_col).isNotNull())
            .groupBy(F.lit(component).alias("component"), F.col(error_col).alias("error_type"))
            .agg(_n().alias("errors")))


def gateway_stats(gated: DataFrame, passed: str = "passed") -> DataFrame:
    """A4: received / filtered / forwarded in one pass (one row)."""
    p = F.col(passed)
    return gated.agg(_n().alias("received"), F.count_if(~p).alias("filtered"),
                     F.count_if(p).alias("forwarded"))


def filter_rate(gated: DataFrame, by: Sequence[str] = (), passed: str = "passed") -> DataFrame:
    """A5: filtered / received x 100, 0 when nothing was received."""
    p = F.col(passed)
    aggs = [_n().alias("received"), F.count_if(~p).alias("filtered")]
    out = gated.groupBy(*by).agg(*aggs) if by else gated.agg(*aggs)
    return out.withColumn("filter_rate", F.when(F.col("received") > 0,
                                                F.col("filtered").cast("double") / F.col("received") * 100.0)
                          .otherwise(F.lit(0.0)))


def rejections_by_filter(gated: DataFrame) -> DataFrame:
    """Rejections labelled by the first rejecting filter."""
    return (gated.filter(F.col("rejected_by").isNotNull())
            .groupBy("rejected_by").agg(_n().alias("n")))


def latency_histogram(df: DataFrame, seconds: Column, by: Sequence[str] = (),
                      buckets: Sequence[float] = LATENCY_BUCKETS, quantiles: Sequence[float] = (0.5, 0.99)) -> DataFrame:
    """Count, sum, cumulative ``le`` buckets and quantiles (``p50``, ``p99``) per group.

    One pass of ``count_if`` per bucket; a quantile is interpolated within the
    bucket that holds its rank (above the last bucket: its bound), so a group
    costs a row of counters however many values it has.
    """
    names = [f"le_{i}" for i in range(len(buckets))]
    aggs = [_n().alias("count"), F.sum(seconds).alias("sum")]
    aggs += [F.count_if(seconds <= F.lit(b)).alias(n) for n, b in zip(names, buckets)]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)

    def at(q: float) -> Column:
        rank, out = F.col("count") * F.lit(q), F.lit(float(buckets[-1]))
        for i in reversed(range(len(buckets))):
            low, below = (float(buckets[i - 1]), F.col(names[i - 1])) if i else (0.0, F.lit(0))
            inside = F.lit(low) + (F.lit(float(buckets[i])) - low) * (rank - below) / (F.col(names[i]) - below)
            out = F.when(F.col(names[i]) >= rank, inside).otherwise(out)
        return out.alias(f"p{round(q * 100)}")

    stack = F.explode(F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(n).alias("bucket_count"))
                                for n, b in zip(names, buckets)]))
    own = [*by, "count", "sum"]
    tops = [f"p{round(q * 100)}" for q in quantiles]
    return wide.select(*own, *[at(q) for q in quantiles], *names).select(*own, *tops, stack.alias("b")).select(
        *own, *tops, "b.le", "b.bucket_count")


#: Size parameter of the quantile sketches and the rank error it stands for (99% confidence, published for KLL).
SKETCH_K, RANK_ERROR = 800, 0.005


def latency_sketches(df: DataFrame, value: Column, window: str = "1 minute", by: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """One mergeable quantile sketch of whole-number values per window and labels."""
    at = F.window(F.col(ts).cast("timestamp"), window)["start"].cast("timestamp_ntz")
    return df.groupBy(at.alias("window_start"), *by).agg(
        F.kll_sketch_agg_bigint(value.cast("bigint"), SKETCH_K).alias("sketch"))


def roll_up(sketches: DataFrame, unit: str, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of longer windows from those of shorter ones; no row is read again."""
    return sketches.groupBy(F.date_trunc(unit, "window_start").cast("timestamp_ntz").alias("window_start"), *by).agg(
        F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, quantiles: Sequence[float] = (0.5, 0.99)) -> DataFrame:
    """Count and quantiles (``p50``, ``p99``) of each sketch, within ``RANK_ERROR`` of the rank."""
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], F.kll_sketch_get_n_bigint("sketch").alias("count"),
                           *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(f"p{round(q * 100)}") for q in quantiles])


def docs_indexed_failed(attempts: DataFrame, component: str, status: str = "status") -> DataFrame:
    """Documents indexed / failed by component and index."""
    ok = F.col(status).between(200, 299)
    return (attempts.groupBy(F.lit(component).alias("component"), "index")
            .agg(F.count_if(ok).alias("docs_indexed"), F.count_if(~ok).alias("docs_failed")))


def bulk_requests_by_status(attempts: DataFrame, status: str = "status") -> DataFrame:
    """Request counter by status."""
    return attempts.groupBy(status).agg(_n().alias("requests"))


def retry_total(attempts: DataFrame, attempt: str = "attempt") -> DataFrame:
    """A10: retries = attempts beyond the first."""
    return attempts.agg(F.sum(F.greatest(F.col(attempt) - 1, F.lit(0))).cast("bigint").alias("retries"))


def last_value(df: DataFrame, value: str, time_col: str, by: Sequence[str] = (),
               name: str = "value") -> DataFrame:
    """A11 / A12 gauge: the value set last wins."""
    agg = F.max_by(F.col(value), F.col(time_col)).alias(name)
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def checkpoint_lag(source: DataFrame, committed: DataFrame, by: Sequence[str] = ("index",),
                   seq: str = "sequence") -> DataFrame:
    """lag = highest source sequence - highest committed sequence (per group).

    Both sides are reduced to one row per group before the join.
    """
    s = source.groupBy(*by).agg(F.max(seq).alias("source_max"))
    c = committed.groupBy(*by).agg(F.max(seq).alias("committed_max"))
    j = s.join(c, list(by), "left")
    return j.withColumn("lag", F.col("source_max") - F.coalesce(F.col("committed_max"), F.lit(-1)))


def pending(df: DataFrame, cursor: int, seq: str = "sequence", by: Sequence[str] = ()) -> DataFrame:
    """Messages not yet delivered past the cursor."""
    f = df.filter(F.col(seq) > F.lit(cursor))
    return f.groupBy(*by).agg(_n().alias("pending")) if by else f.agg(_n().alias("pending"))


def published(df: DataFrame, subject_col: str = "subject") -> DataFrame:
    """Acked publishes by subject."""
    return df.groupBy(subject_col).agg(_n().alias("published"))
