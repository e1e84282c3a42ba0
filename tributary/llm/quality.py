"""Operator 5: quality by hierarchical empirical Bayes over sites.

A logistic regression on a few counts of a text (``FEATURES``) gives each document
its evidence, the odds that its quality is good.  Grouped aggregation turns the
evidence into posteriors level by level: all documents, then hosts, then paths
of a host.  A site's rate is its documents' mean probability shrunk toward its
parent's rate, ``(sum + strength * parent) / (n + strength)``; the strength of a
level comes from the data, by the method of moments over that level's sites, so
sparse sites stay near the level above.  A document's own part is taken out of
its site's sums, and its posterior odds are its evidence times the odds of its
path's rate over those of all documents.

The classifier is fitted on about ``SAMPLE`` labelled documents, drawn by a hash
of the id; everything else covers all documents.

Defined cases: null and empty texts are scored from zero counts; documents
without host or path share the site of the null value; without good or without
bad labels every score is 0.5 at the document level; a document with several
labels is good if all say so; repeated rows count each; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import add_columns, drop_staged, held_out, staged
from tributary.llm.linear import fit_logistic, sigmoid

FEATURES = ("log words", "distinct share", "top word share", "repeated pair share", "word length", "no letter words",
            "symbols", "digits", "capitals", "line repeats", "bars", "shouts", "first word share", "capital words")
SAMPLE = 6000
#: A document is kept unless its posterior says it is rather bad.
KEEP_AT = 0.3
#: Bounds of a level's strength, in documents.
STRENGTH = (1.0, 1e4)

_KIND = np.zeros(256, np.int8)
_KIND[48:58] = 1                                   # digits
_KIND[65:91] = 2                                   # capitals
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3
_KIND[[ord(c) for c in ".,'\"-;:?()"]] = 0         # ordinary punctuation


def measure(text: bytes) -> list[float]:
    """The counts of one text, each roughly within 0 and 1."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    seen = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    buf = np.frombuffer(text, np.uint8)
    kinds = np.bincount(_KIND[buf], minlength=4) / len(buf)
    lines = [x for x in text.split(b"\n") if x]
    plain = sum(c for w, c in seen.items() if not w.lower().islower() and not max(w) > 127)
    return [np.log1p(n) / 10, len(seen) / n, max(seen.values()) / n, 1 - len(pairs) / max(1, n - 1),
            min(1.0, len(text) / n / 20), plain / n, min(1.0, 5 * kinds[3]), min(1.0, 5 * kinds[1]), kinds[2],
            1 - len(set(lines)) / len(lines), min(1.0, 20 * text.count(b"|") / len(text)),
            min(1.0, 20 * text.count(b"!") / len(text)), seen[words[0]] / n, sum(c for w, c in seen.items() if w.isupper()) / n]


def _expand(x: np.ndarray) -> np.ndarray:
    """The counts and their squares."""
    return np.concatenate([x, x * x], axis=1)


def _measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    def make():
        return lambda texts: {"counts": [measure((t or "").encode("utf-8", "surrogatepass")) for t in texts]}
    return add_columns(docs, "text", "counts array<float>", make, keep)


def train(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """Weights and intercept, or None without both labels; ``labels``: ``doc_id, quality``, one row per document."""
    n = labels.count()
    draw = F.crc32(F.concat_ws(":", F.lit("quality"), F.col("doc_id").cast("string")).cast("binary")) / F.lit(2.0**32)
    # about ``sample`` ids: a bounded broadcast
    rows = (measured.select("doc_id", "counts").join(F.broadcast(labels.where(draw < sample / max(n, 1))), "doc_id")
            .toPandas().sort_values("doc_id", kind="stable"))
    y = rows["quality"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return None
    x = _expand(np.array(rows["counts"].tolist(), np.float64))
    row, col = np.indices(x.shape)
    return fit_logistic(row.ravel(), col.ravel(), x.ravel(), y, x.shape[1], ridge=1e-4, rounds=1500)


def _shrunk(docs: DataFrame, sites: DataFrame, site: list[str], parent: Column, rate: str) -> DataFrame:
    """Adds ``rate``: each document's site's rate without itself, shrunk toward ``parent``.

    ``sites`` has ``n``, ``s`` (sum of probabilities) and ``v`` (sum of squares) per site.
    """
    # method of moments: within-site variance over between-site variance of the site means
    m = sites.where("n > 1").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("v") - F.col("s") * F.col("s") / F.col("n")).alias("inner"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("means"), F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    low, high = STRENGTH
    strength = high
    if m["k"] and m["k"] > 1 and m["n"] > m["k"]:
        within = m["inner"] / (m["n"] - m["k"])
        spread = m["n"] - m["nn"] / m["n"]
        between = (m["means"] - m["s"] ** 2 / m["n"] - (m["k"] - 1) * within) / spread
        strength = min(high, max(low, within / between)) if between > 0 else high
    own = F.col("p") * F.lit(1.0)
    return (docs.join(sites.select(F.struct(*site).alias("_site"), "n", "s"), F.struct(*site) == F.col("_site"))
            .withColumn(rate, (F.col("s") - own + F.lit(float(strength)) * parent) / (F.col("n") - 1 + F.lit(float(strength))))
            .drop("_site", "n", "s"))


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE,
                  sites: DataFrame | None = None) -> DataFrame:
    """``(doc_id, host, path, evidence, site_rate, score, kept)``; ``docs``: ``doc_id, text, source``.

    ``sites`` has ``doc_id, host, path``, one row per document; a document without one has its
    source as host and no path.  Texts are measured where they are read and move nowhere.
    """
    counted = _measured(docs, ["doc_id", "source"])
    if sites is None:
        placed = counted.withColumns({"host": F.col("source"), "path": F.lit(None).cast("string")})
    else:
        placed = counted.join(sites.select("doc_id", "host", "path"), "doc_id", "left").withColumn(
            "host", F.coalesce("host", "source"))
    measured = staged(placed.select("doc_id", "host", "path", "counts"), "quality-counts")
    known = (labels.where(learn & F.col("quality").isNotNull()).groupBy("doc_id")
             .agg(F.min("quality").cast("int").alias("quality")))
    model = train(measured, known, sample)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = np.full(len(b), 0.5)
            if model is not None and len(b):
                p = sigmoid(_expand(np.array(b["counts"].tolist(), np.float64)) @ model[0] + model[1])
            yield b.drop(columns="counts").assign(p=np.clip(p, 1e-6, 1 - 1e-6))

    rated = staged(measured.mapInPandas(run, "doc_id long, host string, path string, p double"), "quality-evidence")
    drop_staged(measured)
    sums = [F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("v")]
    paths = staged(rated.groupBy("host", "path").agg(*sums), "quality-sites")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("v").alias("v"))
    total = hosts.agg(F.sum("n"), F.sum("s")).first()
    prior = min(1 - 1e-6, max(1e-6, total[1] / total[0])) if total[0] else 0.5
    leveled = _shrunk(rated, hosts, ["host"], F.lit(prior), "host_rate")
    leveled = _shrunk(leveled, paths, ["host", "path"], F.col("host_rate"), "site_rate")
    odds = lambda c: F.log(c / (1 - c))                                    # noqa: E731
    site = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("site_rate")))
    z = odds(F.col("p")) + odds(site) - F.lit(float(np.log(prior / (1 - prior))))
    return leveled.select("doc_id", "host", "path", F.col("p").alias("evidence"), "site_rate",
                          (1 / (1 + F.exp(-z))).alias("score")).withColumn("kept", F.col("score") >= KEEP_AT)


def sites_of(pages: DataFrame) -> DataFrame:
    """``(doc_id, host, path)`` of the pages whose address ends in a document's number.

    Of several pages the smallest address counts.
    """
    return (pages.select("url", F.regexp_extract("url", r"^[a-z]+://([^/?#]+)/", 1).alias("_host"),
                         F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([^/?#]+)/", 1).alias("_path"),
                         F.regexp_extract("url", r"^[a-z]+://[^?#]*/([0-9]+)(?:\.html)?/?(?:[?#].*)?$", 1).alias("_id"))
            .where("_id <> ''").groupBy(F.expr("try_cast(_id as bigint)").alias("doc_id"))
            .agg(F.min(F.struct("url", "_host", "_path")).alias("_page")).where("doc_id is not null")
            .select("doc_id", F.col("_page._host").alias("host"), F.col("_page._path").alias("path")))


def classify(docs: DataFrame, pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered form: a fifth of the ids is held out of training."""
    out = score_quality(docs.select("doc_id", "text", "source"), labels, ~held_out(F.col("doc_id"), 5, 3),
                        sites=sites_of(pages))
    return out.withColumn("held_out", held_out(F.col("doc_id"), 5, 3))
