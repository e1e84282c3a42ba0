"""Operator 10: language identification by prediction by partial matching.

Each language has a context tree over the bytes of its texts, of orders 0 to
``ORDER``.  In a context seen ``n`` times with ``d`` distinct next bytes, a byte
seen ``c`` times costs ``-log2(c / (n + d))`` bits; an unseen one pays the escape
``-log2(d / (n + d))`` and is coded in the next shorter context; a context the
language never met costs nothing to leave; below order 0 every byte costs 8
bits.  (Escape method C, without exclusions.)  The statistics are frozen after
training, so the code length of a text is a sum over its byte windows and each
distinct window has one cost per language: all windows met in training are
looked up in a table, the others are coded step by step down the trees.

The language with the shortest code wins (ties: the smaller value).  ``score`` is
its share of ``2 ** -(bits per byte)`` summed over the languages.  Texts
without a letter are ``und`` with score 0.

Training takes whole texts of about ``SAMPLE_PER_LANG`` labelled documents per
language, drawn by a hash of the id; what reaches the driver is one count per
distinct window and language of that sample, whatever the corpus size.

Defined cases: a null or letterless text is ``und``; documents without ``lang`` are
predicted but not learned from; with no labelled document all are ``und``;
repeated rows get equal results; an empty table gives an empty one; other
columns pass through where ``keep`` names them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import add_columns, bounded, encoded, held_out

ORDER = 3
SAMPLE_PER_LANG = 600
UNKNOWN = "und"
#: Byte pairs that get a place in the direct table; others take the tree walk.
DIRECT_PAIRS = 3000


def windows(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ``ORDER`` bytes before each byte and the byte itself, as one number.

    Before a text stand zero bytes, so its first bytes have a context too.
    """
    x = buf.astype(np.uint32)
    out = x.copy()
    for k in range(1, ORDER + 1):
        prev = np.zeros_like(x)
        prev[k:] = x[:-k]
        for j in range(k):                       # no context from the text before
            at = starts + j
            prev[at[at < len(x)]] = 0
        out |= prev << np.uint32(8 * k)
    return out


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else sizes
    return np.frombuffer(b"".join(texts), np.uint8), starts, sizes


def _own_context(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return starts[sizes > 0]


class Trees:
    """The frozen context trees of all languages."""

    def __init__(self, langs: list[str], window: np.ndarray, lang: np.ndarray, count: np.ndarray):
        self.langs = langs
        n = len(langs)
        self.seen: list[tuple[np.ndarray, np.ndarray]] = []      # order k: windows, counts per language
        self.contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []   # contexts, totals, distinct
        for k in range(ORDER + 1):
            keys, inv = np.unique(window & np.uint32((1 << 8 * (k + 1)) - 1), return_inverse=True)
            counts = np.zeros((len(keys), n))
            np.add.at(counts, (inv, lang), count)
            ctx, cinv = np.unique(keys >> np.uint32(8), return_inverse=True)
            totals, distinct = np.zeros((len(ctx), n)), np.zeros((len(ctx), n))
            np.add.at(totals, cinv, counts)
            np.add.at(distinct, cinv, counts > 0)
            self.seen.append((keys, counts))
            self.contexts.append((ctx, totals, distinct))
        keys = self.seen[ORDER][0]
        self.costs = self.code_length(keys).astype(np.float32)
        # direct table: (pair of bytes, next pair) -> row of costs
        pairs, uses = np.unique(np.concatenate([keys >> np.uint32(16), keys & np.uint32(0xFFFF)]), return_counts=True)
        pairs = pairs[np.argsort(-uses, kind="stable")[:DIRECT_PAIRS]]
        self.width = len(pairs) + 1
        self.pair = np.zeros(65536, np.int32)
        self.pair[pairs] = np.arange(1, self.width, dtype=np.int32)
        self.row = np.full(self.width * self.width, -1, np.int32)
        a, b = self.pair[keys >> np.uint32(16)], self.pair[keys & np.uint32(0xFFFF)]
        both = (a > 0) & (b > 0)
        self.row[a[both].astype(np.int64) * self.width + b[both]] = np.flatnonzero(both).astype(np.int32)

    def code_length(self, window: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each window, one column per language."""
        bits = np.zeros((len(window), len(self.langs)))
        todo = np.ones(bits.shape, bool)
        for k in range(ORDER, -1, -1):
            key = window & np.uint32((1 << 8 * (k + 1)) - 1)
            ctx, totals, distinct = self.contexts[k]
            at, hit = _find(ctx, key >> np.uint32(8))
            t, d = np.where(hit[:, None], totals[at], 0), np.where(hit[:, None], distinct[at], 0)
            keys, counts = self.seen[k]
            at, hit = _find(keys, key)
            c = np.where(hit[:, None], counts[at], 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                coded = np.where(c > 0, np.log2((t + d) / c), 0)
                escaped = np.where(t > 0, np.log2((t + d) / d), 0)
            bits += np.where(todo, np.where(c > 0, coded, escaped), 0)
            todo &= c == 0
        return bits + 8.0 * todo

    def totals(self, buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Code length of each text of a joined buffer, one column per language."""
        out = np.zeros((len(starts), len(self.langs)))
        if not len(buf):
            return out
        w = windows(buf, _own_context(starts, sizes))
        row = self.row[self.pair[w >> np.uint32(16)].astype(np.int64) * self.width + self.pair[w & np.uint32(0xFFFF)]]
        far = np.flatnonzero(row < 0)
        extra = None
        if len(far):
            keys, inv = np.unique(w[far], return_inverse=True)
            extra = self.code_length(keys)[inv]
        full = sizes > 0
        for j in range(len(self.langs)):
            bits = self.costs[:, j][row].astype(np.float64) if len(self.costs) else np.zeros(len(row))
            if extra is not None:
                bits[far] = extra[:, j]
            out[full, j] = np.add.reduceat(bits, starts[full])
        return out


def _find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return at, keys[at] == x


def has_letter(text) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


def train(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Trees | None:
    """Context trees from about ``per_lang`` whole texts of each value of ``lang``."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = known.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(per_lang)) / F.count(F.lit(1))).alias("share"))
    shares = {r["lang"]: r["share"] for r in share.collect()}
    if not shares:
        return None
    langs = sorted(shares)
    rate = F.element_at(F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(shares[k]))]), F.col("lang"))
    draw = (F.crc32(F.concat_ws(":", F.lit("ppm"), F.col("doc_id").cast("string")).cast("binary")) / F.lit(2.0**32))
    sample = known.where(draw < rate).select("lang", "text")
    code = {k: i for i, k in enumerate(langs)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, rows in b.groupby("lang")["text"]:
                buf, starts, sizes = _joined(encoded(rows))
                if len(buf):
                    w, n = np.unique(windows(buf, _own_context(starts, sizes)), return_counts=True)
                    yield pd.DataFrame({"lang": code[lang], "window": w.astype(np.int64), "n": n})

    got = (sample.mapInPandas(count, "lang int, window long, n long")
           .groupBy("lang", "window").agg(F.sum("n").alias("n")).toPandas().sort_values(["lang", "window"]))
    if not len(got):
        return None
    return Trees(langs, got["window"].to_numpy().astype(np.uint32), got["lang"].to_numpy(), got["n"].to_numpy())


def identify(docs: DataFrame, learn: Column, keep: list[str] = ("doc_id",),
             per_lang: int = SAMPLE_PER_LANG, trees: Trees | None = None) -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``score``; rows where ``learn`` holds may train, unless ``trees`` are given."""
    spark = bounded(docs)
    if trees is None:
        trees = train(docs.where(learn).select("doc_id", "lang", "text"), per_lang)
    model = spark.sparkContext.broadcast(trees)

    def make():
        t = model.value

        def predict(texts):
            lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if t is not None:
                buf, starts, sizes = _joined(encoded(texts))
                per = t.totals(buf, starts, sizes) / np.maximum(sizes, 1)[:, None]
                best = per.argmin(axis=1)
                low = per[np.arange(len(per)), best]
                ok = np.array([has_letter(x) for x in texts], bool)
                lang[ok] = np.array(t.langs, object)[best[ok]]
                score[ok] = (1.0 / np.exp2(low[:, None] - per).sum(axis=1))[ok]
            return {"lang_pred": lang, "score": score}
        return predict

    return add_columns(docs, "text", "lang_pred string, score double", make, list(keep), limit=1 << 19)


def predict_languages(docs: DataFrame) -> DataFrame:
    """The registered form: a fourth of the rows is held out of training."""
    out = held_out(F.col("doc_id"), 4, 2)
    return identify(docs.withColumn("held_out", out), ~out, keep=["doc_id", "held_out"])
