import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import quality, toxicity
from tributary.llm.linear import fit_logistic, fit_scaled, sigmoid
from tributary.llm.queries import QUERIES
from helpers import docs_frame, odd_rows

SF = "/root/testdata/sf0.01"


def test_logistic_fit_finds_the_weights():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    y = (rng.random(4000) < sigmoid(x @ [2.0, -1.0, 0.0] + 0.5)).astype(float)
    row, col = np.indices(x.shape)
    w, b = fit_logistic(row.ravel(), col.ravel(), x.ravel(), y, 3, rounds=1500)
    np.testing.assert_allclose([*w, b], [2, -1, 0, 0.5], atol=0.25)


def test_ngrams_stay_within_their_text():
    texts = ["abcdefgh", "", "ab", "cdefgabcd", "日本語の文", "éééé"]
    doc, bucket = toxicity.buckets(texts)
    alone = [sorted(toxicity.buckets([t])[1].tolist()) for t in texts]
    assert [sorted(bucket[doc == i].tolist()) for i in range(6)] == alone
    assert [len(a) for a in alone] == [5 + 4, 0, 0, 6 + 5, 2 + 1, 1]      # characters, not bytes
    assert len(set(alone[0]) & set(alone[3])) == 4          # abcd, cdef, defg and cdefg


def test_toxicity_agrees_with_the_rule_written_out(spark):
    """Log-count ratios and scores worked out document by document."""
    rng = np.random.default_rng(5)
    words = ["the", "quick", "idiot", "Fox", "größe", "jumps", "scum", "over"]
    texts = [" ".join(rng.choice(words, rng.integers(1, 9))) for _ in range(60)]
    toxic = [int("idiot" in t or "scum" in t) for t in texts]
    df = docs_frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, 1, y) for i, y in enumerate(toxic[:40])], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(df, labels, F.lit(True)).collect()}
    def one(g):
        """The bucket of one n-gram: what its text has beyond the shorter n-grams in it."""
        own = set(toxicity.buckets([g])[1].tolist())
        return own if len(g) == 4 else own - one(g[:4]) - one(g[1:])
    grams = [{x for k in (4, 5) for i in range(len(t) - k + 1) for x in one(t.lower()[i:i + k])} for t in texts]
    p, q = {}, {}
    for g, y in zip(grams[:40], toxic):
        for x in g:
            (p if y else q)[x] = (p if y else q).get(x, 0) + 1
    n1, n0, scale = sum(toxic[:40]), 40 - sum(toxic[:40]), np.zeros(toxicity.BUCKETS)
    for x in p.keys() | q.keys():
        a, b = p.get(x, 0) + 1, q.get(x, 0) + 1
        r = np.log(a / (n1 + 2)) - np.log(b / (n0 + 2))
        z2 = r * r / (1 / a + 1 / b)
        scale[x] = r * z2 / (z2 + 9)
    cols = [np.array(sorted(g), np.int32) for g in grams]
    w, b, slope, offset = toxicity.fit(cols[:40], np.array(toxic[:40], float), scale, n1 / 40)
    for i, c in enumerate(cols):
        s = 3 * np.tanh((sum(w[x] for x in c) + b) / 3)
        assert abs(got[i] - 1 / (1 + np.exp(-(slope * s + offset)))) < 1e-6


def test_chunks_of_features_fit_alike():
    rng = np.random.default_rng(2)
    cols = [np.unique(rng.integers(0, 50, rng.integers(0, 12))).astype(np.int32) for _ in range(200)]
    y, scale = rng.integers(0, 2, 200).astype(float), rng.normal(size=50)
    whole, parts = fit_scaled(cols, y, scale), fit_scaled(cols, y, scale, chunk=37)
    np.testing.assert_allclose(whole[0], parts[0], atol=1e-9)
    row, col = np.repeat(np.arange(200), [len(c) for c in cols]), np.concatenate(cols)
    w, b = fit_logistic(row, col, scale[col], y, 50, ridge=3e-4, rounds=60)
    np.testing.assert_allclose(whole[0], w * scale, atol=1e-6)


@pytest.mark.parametrize("share,insults,least", [(0.5, 120, 0.5), (0.1, 30, 0.6), (0.02, 6, 0.6)])
def test_rare_insults_are_found_at_any_toxic_share(share, insults, least):
    """Each insult marks few documents; all features count, none is cut by how many documents have it."""
    rng = np.random.default_rng(int(share * 100))
    word = lambda a, b: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(a, b)))
    words, bad = [word(3, 9) for _ in range(800)], [word(6, 10) for _ in range(insults)]
    y = (rng.random(3000) < share).astype(float)
    texts = [" ".join([*rng.choice(words, rng.integers(15, 40)), *([rng.choice(bad)] if t else [])]) for t in y]
    cols = [np.sort(toxicity.buckets([t])[1]).astype(np.int32) for t in texts]
    train = np.arange(3000) % 3 > 0
    p, q = (np.bincount(np.concatenate([c for c, k in zip(cols, train & (y == v)) if k]), minlength=toxicity.BUCKETS) + 1 for v in (1, 0))
    r = np.log(p / (y[train].sum() + 2)) - np.log(q / ((1 - y[train]).sum() + 2))
    z2 = r * r / (1 / p + 1 / q)
    scale = np.where((p > 1) | (q > 1), r * z2 / (z2 + toxicity.CERTAIN**2), 0)
    w, b, slope, offset = toxicity.fit([c for c, t in zip(cols, train) if t], y[train], scale, y[train].mean())
    s = toxicity.squashed([w[c].sum() + b for c, t in zip(cols, train) if not t])
    hit = sigmoid(slope * s + offset) >= toxicity.TOXIC_AT
    assert hit[y[~train] == 1].mean() >= least and y[~train][hit].mean() >= 0.9


def test_toxicity_on_held_out_rows(spark):
    got = QUERIES["op8_toxicity"](spark, SF).collect()
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    right = {0: [], 1: []}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["held_out"] and r["doc_id"] in labels and labels[r["doc_id"]]["quality"] == 1:
            right[labels[r["doc_id"]]["toxic"]].append(r["predicted"])
    assert np.mean(right[0]) <= 0.02 and np.mean(right[1]) >= 0.8


def test_toxicity_of_odd_rows(spark):
    df = docs_frame(spark, odd_rows(), extra=True)
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 1), (8, 1, 1), (8, 0, 0), (None, 1, 1), (7, 0, None)],
                                   "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.where("toxic = 0")):
        got = toxicity.score_documents(df, known, F.lit(True)).collect()
        assert len(got) == len(odd_rows())
        assert all(0 <= r["score"] <= 1 for r in got)
        by_id = {}
        for r in got:
            by_id.setdefault(r["doc_id"], set()).add(r["score"])
        assert len(by_id[1] | by_id[2]) == 1 and len(by_id[5] | by_id[6]) == 1 and by_id[3] == by_id[4]
    assert toxicity.score_documents(df.limit(0), labels, F.lit(True)).count() == 0


def test_quality_on_held_out_rows(spark):
    got = {r["doc_id"]: r for r in QUERIES["op5_quality"](spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    right = {0: [], 1: []}
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        if got[r["doc_id"]]["held_out"] and r["quality"] is not None:
            right[r["quality"]].append(got[r["doc_id"]]["kept"])
    assert np.mean(right[1]) >= 0.99 and np.mean(right[0]) <= 0.1


def test_site_rates_agree_with_the_plain_formula(spark):
    rng = np.random.default_rng(5)
    rows = []
    for h in range(6):
        for p in range(3):
            rate = [0.9, 0.2][h % 2] * [1.0, 0.8, 0.5][p]
            rows += [(len(rows) + i, f"h{h}" if h else None, f"p{p}" if p else None, float(np.clip(rng.normal(rate, 0.1), 0.01, 0.99)))
                     for i in range(int(rng.integers(1, 25)))]
    df = spark.createDataFrame(rows, "doc_id long, host string, path string, p double")
    sums = [F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("v")]
    got = {r["doc_id"]: r["r"] for r in quality._shrunk(df, df.groupBy("host").agg(*sums), ["host"], F.lit(0.6), "r").collect()}
    groups = {}
    for d, h, _, p in rows:
        groups.setdefault(h, []).append((d, p))
    many = [np.array([p for _, p in g]) for g in groups.values() if len(g) > 1]
    n, k = sum(map(len, many)), len(many)
    within = sum(((g - g.mean()) ** 2).sum() for g in many) / (n - k)
    mean = sum(g.sum() for g in many) / n
    between = (sum(len(g) * (g.mean() - mean) ** 2 for g in many) - (k - 1) * within) / (n - sum(len(g) ** 2 for g in many) / n)
    strength = min(1e4, max(1.0, within / between))
    for g in groups.values():
        for d, p in g:
            want = (sum(x for _, x in g) - p + strength * 0.6) / (len(g) - 1 + strength)
            assert got[d] == pytest.approx(want, rel=1e-6)


def test_sparse_sites_shrink_and_large_ones_speak(spark):
    rows = [(i, "good words in a plain sentence number " + str(i), "h1", "p") for i in range(40)]
    rows += [(100 + i, "spam " * 40, "h2", "p") for i in range(40)] + [(200, "good words in a plain sentence", "h3", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string").withColumn("source", F.lit("s"))
    labels = spark.createDataFrame([(i, 1) for i in range(0, 40, 2)] + [(100 + i, 0) for i in range(0, 40, 2)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.score_quality(docs, labels, F.lit(True), sites=docs).collect()}
    assert got[1]["site_rate"] > got[200]["site_rate"] > got[101]["site_rate"]
    assert got[1]["kept"] and got[200]["kept"] and not got[101]["kept"]


def test_quality_of_odd_rows_and_sites(spark):
    df = docs_frame(spark, odd_rows(), extra=True)
    pages = spark.createDataFrame([(1, "https://a.example/en/8"), (2, "http://b.example/de/8.html?x=1"), (3, None), (4, "junk"),
                                   (5, "https://c.example/x/y/7/#top")], "page_id long, url string")
    at = {r["doc_id"]: (r["host"], r["path"]) for r in quality.classify(
        df, pages, spark.createDataFrame([], "doc_id long, quality int")).collect()}
    assert at[8] == ("b.example", "de") and at[7] == ("c.example", "x") and at[5] == ("b", None) and at[2] == (None, None)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        got = quality.score_quality(df, known, F.lit(True), sites=quality.sites_of(pages)).collect()
        assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert quality.classify(df.limit(0), pages, labels).count() == 0
