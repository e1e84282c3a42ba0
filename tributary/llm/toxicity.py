"""Operator 8: toxicity by character n-grams scaled with naive Bayes log-count ratios.

Features are the n-grams (``SIZES`` code points) of the lower-cased text, hashed to
``BUCKETS``; a document has a feature or not.  The classifier is fitted on about
``SAMPLE_PER_CLASS`` labelled documents of each label (all of them, if fewer),
drawn by a hash of the id; the drawn ids are few, so they go to the documents
and no text moves.  Spark counts, per bucket, the toxic and the other documents
that have it.  The log ratio ``r`` of the two smoothed rates, ``z`` standard errors from
zero, scales the feature by ``r z^2 / (z^2 + CERTAIN^2)``: no feature is left out, an
uncertain one counts little.  A logistic regression over all scaled features is
fitted in one task, which holds the sample's features (``2 * SAMPLE_PER_CLASS``
documents) and nothing else.  Its sums are squashed to +-``SQUASH``, so that a long
text's many weak features don't settle it, and turned into odds by a slope and an
offset fitted on rows that were left out of a fit (each half of the sample by the
other), weighted to the rates of all training rows.  What reaches the driver is
bounded by the buckets.

Defined cases: null and empty texts have no feature and score as the intercept
does; without toxic or without other training rows every score is 0;
a document with several labels is toxic if one says so; repeated rows get equal
scores; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import add_columns, bounded, chunks, drop_staged, held_out, mix, staged
from tributary.llm.linear import calibration, fit_scaled, sigmoid

SIZES = (4, 5)
BUCKETS = 1 << 20
SAMPLE_PER_CLASS = 4000
#: Added to each count.
SMOOTHING = 1.0
#: Standard errors at which a log ratio counts for half.
CERTAIN = 3.0
SQUASH = 3.0
TOXIC_AT = 0.7
_BASE = np.uint64(0x9E3779B97F4A7C15)


def buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every distinct n-gram of a text; n-grams don't cross texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    value = mix(points.astype(np.uint64) + np.uint64(77))
    doc, own = np.repeat(np.arange(len(texts), dtype=np.int64), sizes), [np.zeros(0, np.int64)]
    for k in SIZES:
        n = len(points) - k + 1
        if n > 0:
            h = np.zeros(n, np.uint64)
            for j in range(k):
                h = h * _BASE + value[j:j + n]
            inside = doc[:n] == doc[k - 1:]
            own.append(doc[:n][inside] * BUCKETS + (mix(h)[inside] & np.uint64(BUCKETS - 1)).astype(np.int64))
    own = np.unique(np.concatenate(own))
    return own // BUCKETS, own % BUCKETS


def _parts(batch: pd.DataFrame):
    texts = [t.lower() if isinstance(t, str) else "" for t in batch["text"].tolist()]
    for part in chunks([len(t) for t in texts], 1 << 19):
        yield part, texts[part]


def ratios(rows: DataFrame, toxic: int, other: int) -> np.ndarray:
    """The scale of every bucket: its log ratio, less where it is uncertain; 0 where no row has it.

    Counted over all of ``rows``, of which ``toxic`` and ``other`` have each label.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            label = b["toxic"].to_numpy()
            for part, texts in _parts(b):
                doc, bucket = buckets(texts)
                hit = label[part][doc] == 1
                n[0] += np.bincount(bucket[hit], minlength=BUCKETS)
                n[1] += np.bincount(bucket[~hit], minlength=BUCKETS)
        at = np.flatnonzero(n.any(axis=0))
        yield pd.DataFrame({"bucket": at.astype(np.int32), "toxic": n[0][at], "other": n[1][at]})

    n = rows.mapInPandas(count, "bucket int, toxic long, other long").groupBy("bucket").agg(
        (F.sum("toxic") + SMOOTHING).alias("p"), (F.sum("other") + SMOOTHING).alias("q"))
    n = n.withColumn("ratio", F.log(F.col("p") / (toxic + 2 * SMOOTHING)) - F.log(F.col("q") / (other + 2 * SMOOTHING)))
    z2 = F.col("ratio") * F.col("ratio") / (1 / F.col("p") + 1 / F.col("q"))
    found = n.select("bucket", (F.col("ratio") * z2 / (z2 + CERTAIN**2)).alias("scale")).toPandas()      # a row a bucket at most
    scale = np.zeros(BUCKETS)
    scale[found["bucket"].to_numpy()] = found["scale"].to_numpy()
    return scale


class Model:
    """Weight times scale of every bucket, intercept, and the line from squashed sums to log odds."""

    def __init__(self, weight: np.ndarray, intercept: float, slope: float, offset: float):
        self.weight, self.intercept, self.slope, self.offset = weight, intercept, slope, offset

    def sums(self, texts: list[str]) -> np.ndarray:
        doc, bucket = buckets(texts)
        return squashed(np.bincount(doc, self.weight[bucket], len(texts)) + self.intercept)

    def score(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.slope * self.sums(texts) + self.offset)


def squashed(s):
    return SQUASH * np.tanh(np.asarray(s) / SQUASH)


def fit(cols: list[np.ndarray], y: np.ndarray, scale: np.ndarray, rate: float) -> tuple[np.ndarray, float, float, float]:
    """Weights, intercept, slope and offset from a sample's features and labels; ``rate``: toxic share of all training rows."""
    weight, intercept = fit_scaled(cols, y, scale)
    share = np.where(y == 1, rate / y.mean(), (1 - rate) / (1 - y.mean()))
    fold = np.zeros(len(y), int)
    for label in (0, 1):
        fold[y == label] = np.arange(int((y == label).sum())) % 2
    if min(int(y.sum()), int((1 - y).sum())) < 2:                     # too few to leave any out
        return weight, intercept, 1.0, float(np.log(rate / (1 - rate)) - np.log(y.mean() / (1 - y.mean())))
    left_out = np.zeros(len(y))
    for k in (0, 1):
        w, b = fit_scaled([c for c, f in zip(cols, fold) if f != k], y[fold != k], scale)
        left_out[fold == k] = [w[c].sum() + b for c, f in zip(cols, fold) if f == k]
    return weight, intercept, *calibration(squashed(left_out), y, share)


def train(texts: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """``texts``: ``doc_id, text``; ``labels``: ``doc_id, toxic``, one row per document that may be learned from."""
    n = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return None
    draw = F.crc32(F.concat_ws(":", F.lit("toxic"), F.col("doc_id").cast("string")).cast("binary")) / F.lit(2.0**32)
    share = F.when(F.col("toxic") == 1, F.lit(per_class / n[1])).otherwise(F.lit(per_class / n[0]))
    # about 2 * per_class ids at most: a bounded broadcast; a repeated id is one document of the sample
    met = texts.join(F.broadcast(labels.where(draw < share)), "doc_id")
    rows = staged(met.groupBy("doc_id", "toxic").agg(F.max("text").alias("text")), "toxic-sample")
    drawn = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not drawn.get(1) or not drawn.get(0):
        drop_staged(rows)
        return None
    spark, rate = rows.sparkSession, n[1] / (n[0] + n[1])
    scale = spark.sparkContext.broadcast(ratios(rows, drawn[1], drawn[0]))

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, texts in _parts(b):
                doc, bucket = buckets(texts)
                cuts = np.searchsorted(doc, np.arange(1, len(texts)))
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[part].to_numpy(), "toxic": b["toxic"].iloc[part].to_numpy(),
                                    "cols": [c.astype(np.int32) for c in np.split(bucket, cuts)]})

    def fit_sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols, y = [], []
        for b in batches:
            cols += [np.array(c, np.int32) for c in b["cols"]]
            y += b["toxic"].tolist()
        if cols:
            weight, *rest = fit(cols, np.array(y, float), scale.value, rate)
            at = np.flatnonzero(weight)
            yield pd.DataFrame({"bucket": [*at.tolist(), -1, -2, -3], "value": [*weight[at].tolist(), *rest]})

    sample = rows.mapInPandas(gather, "doc_id long, toxic int, cols array<int>").repartition(1).sortWithinPartitions("doc_id", "toxic")
    fitted = sample.mapInPandas(fit_sample, "bucket int, value double").toPandas()
    drop_staged(rows)
    value = dict(zip(fitted["bucket"].iloc[-3:], fitted["value"].iloc[-3:]))
    weight, kept = np.zeros(BUCKETS), fitted.iloc[:-3]
    weight[kept["bucket"].to_numpy()] = kept["value"].to_numpy()
    return Model(weight, value[-1], value[-2], value[-3])


def score_documents(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """``(doc_id, score, predicted)`` of every document; ``learn`` tells which labels may be learned."""
    known = (labels.where(learn & F.col("toxic").isNotNull()).groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")))
    bounded(docs)
    texts = docs.select("doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(train(texts, known, per_class))

    def make():
        m = model.value

        def score(rows):
            p = m.score([t.lower() if t else "" for t in rows]) if m else np.zeros(len(rows))
            return {"score": p, "predicted": (p >= TOXIC_AT).astype(np.int32)}
        return score

    return add_columns(texts, "text", "score double, predicted int", make, ["doc_id"], limit=1 << 18)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered form: a third of the ids is held out of training."""
    out = score_documents(docs, labels, ~held_out(F.col("doc_id"), 3, 1))
    return out.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")
