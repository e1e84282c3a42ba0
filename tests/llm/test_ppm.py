import math
import zlib

import numpy as np

from tributary.llm import ppm
from tributary.llm.common import held_out
from tributary.llm.queries import QUERIES
from helpers import docs_frame, odd_rows
from pyspark.sql import functions as F


def plain_cost(texts, data):
    """Code length of ``data`` under context counts of ``texts``, byte by byte."""
    seen = {}
    for t in texts:
        t = bytes(ppm.ORDER) + t
        for i in range(ppm.ORDER, len(t)):
            for k in range(ppm.ORDER + 1):
                c = seen.setdefault((k, t[i - k:i]), {})
                c[t[i]] = c.get(t[i], 0) + 1
    bits, data = 0.0, bytes(ppm.ORDER) + data
    for i in range(ppm.ORDER, len(data)):
        for k in range(ppm.ORDER, -1, -1):
            c = seen.get((k, data[i - k:i]))
            if not c:
                continue
            n, d = sum(c.values()), len(c)
            if data[i] in c:
                bits -= math.log2(c[data[i]] / (n + d))
                break
            bits -= math.log2(d / (n + d))
        else:
            bits += 8
    return bits


def trees_of(groups):
    w, l, n = [], [], []
    for i, texts in enumerate(groups):
        buf, starts, sizes = ppm._joined(texts)
        keys, counts = np.unique(ppm.windows(buf, ppm._own_context(starts, sizes)), return_counts=True)
        w.append(keys)
        l.append(np.full(len(keys), i))
        n.append(counts)
    return ppm.Trees([f"l{i}" for i in range(len(groups))], np.concatenate(w), np.concatenate(l), np.concatenate(n))


def test_code_lengths_agree_with_the_plain_rule():
    groups = [[b"abracadabra", b"", b"cadabra abra"], [b"the cat sat on the mat", b"\x00\xff"]]
    data = [b"", b"abra", b"the zebra", b"\xff\xfe", b"a", "é the".encode()]
    buf, starts, sizes = ppm._joined(data)
    for pairs in (3000, 2):                         # with and without the direct table for most windows
        ppm.DIRECT_PAIRS, kept = pairs, ppm.DIRECT_PAIRS
        got = trees_of(groups).totals(buf, starts, sizes)
        ppm.DIRECT_PAIRS = kept
        want = [[plain_cost(g, d) for g in groups] for d in data]
        np.testing.assert_allclose(got, want, rtol=1e-4, atol=1e-4)


def test_odd_rows(spark):
    df = docs_frame(spark, odd_rows(), extra=True)
    got = ppm.identify(df, F.lit(True), keep=df.columns).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1
        assert r["key"] == "own key"
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2)} == {"en"}
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in ppm.identify(unlabelled, F.lit(True)).collect()} == {"und"}
    assert ppm.identify(df.limit(0), F.lit(True)).count() == 0


def test_held_out_accuracy_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op10_language_id"](spark, sf).collect()
    assert len(got) == len(docs)
    right = total = 0
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        if r["held_out"] and docs[r["doc_id"]]["lang"] is not None and r["lang_pred"] != "und":
            total += 1
            right += r["lang_pred"] == docs[r["doc_id"]]["lang"]
    assert total > 100 and right >= 0.97 * total


def test_held_out_rule(spark):
    got = spark.range(50).select("id", held_out(F.col("id"), 3, 1).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in got)
