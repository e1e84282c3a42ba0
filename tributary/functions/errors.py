"""Error classes, status classes, retry schedule, error context and log levels
(P15-P20) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions.envelope import col
from tributary.operators.metrics import RETRYABLE_ERRORS, TRANSIENT_ERRORS

# Retry policy defaults.
MAX_ATTEMPTS = 3
INITIAL_DELAY_MS = 100
MAX_DELAY_MS = 10_000
MULTIPLIER = 2.0


def is_retryable(kind="error_kind") -> Column:
    """P15."""
    return col(kind).isin(*RETRYABLE_ERRORS)


def is_transient(kind="error_kind") -> Column:
    """P15."""
    return col(kind).isin(*TRANSIENT_ERRORS)


def item_success(status="status") -> Column:
    """200 <= status < 300."""
    return col(status).between(200, 299)


def request_class(status="status", attempt="attempt", max_attempts: int = MAX_ATTEMPTS) -> Column:
    """Success; retry on 5xx while attempts are left; otherwise fail (4xx never retried)."""
    s, a = col(status), col(attempt)
    return (F.when(s.between(200, 299), F.lit("success"))
            .when(s.between(500, 599) & (a < max_attempts), F.lit("retry"))
            .otherwise(F.lit("fail")))


def backoff_ms(attempt="attempt", initial_ms: int = INITIAL_DELAY_MS, multiplier: float = MULTIPLIER,
               max_ms: int = MAX_DELAY_MS) -> Column:
    """``min(initial * multiplier^(attempt-1), max)`` milliseconds, truncated."""
    raw = F.floor(F.lit(float(initial_ms)) * F.pow(F.lit(multiplier), col(attempt) - 1))
    return F.least(raw.cast("bigint"), F.lit(max_ms).cast("bigint"))


def should_retry(attempt="attempt", max_attempts: int = MAX_ATTEMPTS) -> Column:
    """P18."""
    return col(attempt) < max_attempts


def error_context(component: str, operation, doc_id=None, index=None, sequence=None) -> Column:
    """``[component::operation] doc=.. index=.. seq=..``; absent parts left out."""
    def part(label, c):
        return None if c is None else F.concat(F.lit(f" {label}="), col(c).cast("string"))
    op = operation if isinstance(operation, Column) else F.lit(operation)
    pieces = [F.concat(F.lit(f"[{component}::"), op, F.lit("]"))]
    pieces += [p for p in (part("doc", doc_id), part("index", index), part("seq", sequence)) if p is not None]
    return F.concat(*[F.coalesce(p, F.lit("")) for p in pieces])


def log_level(line="line") -> Column:
    """P20: first rule wins: error, warn, debug, else info."""
    s = col(line)
    return (F.when(s.contains("[ERR]") | s.contains("[FTL]"), F.lit("error"))
            .when(s.contains("[WRN]"), F.lit("warn"))
            .when(s.contains("[DBG]") | s.contains("[TRC]"), F.lit("debug"))
            .otherwise(F.lit("info")))
