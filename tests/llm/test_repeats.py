import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tributary.llm import repeats
from tributary.llm.queries import QUERIES
from helpers import docs_frame, odd_rows


def plain(texts, length=200):
    """Every string of ``length`` bytes counted, every covered byte marked."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def sample(seed, n=160):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    para = lambda k: " ".join(rng.choice(words) for _ in range(k))
    base, out = [para(rng.randrange(5, 200)) for _ in range(20)], []
    for _ in range(n):
        k = rng.random()
        if k < 0.15:
            out.append(rng.choice(base))
        elif k < 0.5:
            t = list(rng.choice(base))
            for _ in range(rng.randrange(1, 6)):
                t[rng.randrange(len(t))] = rng.choice("xyz")
            out.append("".join(t))
        elif k < 0.7:
            t = rng.choice(base)
            a = rng.randrange(len(t))
            out.append(para(20) + t[a:a + rng.randrange(150, 400)] + para(20))
        elif k < 0.8:
            out.append("a" * rng.randrange(190, 450))
        elif k < 0.85:
            out.append("ab" * rng.randrange(90, 300) + para(3))
        else:
            out.append(para(rng.randrange(1, 150)))
    return out + ["", None, "é" * 100, "é" * 101, "x" * 199, "x" * 200, "q" * 200]


def check(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    df = docs_frame(spark, [(i, t, "en", "s") for i, t in zip(ids, texts)], extra=True).repartition(5)
    got = sorted((tuple(r) for r in repeats.repeat_digests(df).collect()), key=str)
    assert got == sorted(((i, *p) for i, p in zip(ids, plain(texts))), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_bytes_agree_with_counting_every_string(spark, seed):
    check(spark, sample(seed))


def test_batches_cut_anywhere(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH", 700)
    check(spark, sample(3, 60))


def test_a_passage_in_every_document_never_fills_a_frame(spark, monkeypatch):
    """A little over 200 bytes that all documents share, each with other text around: judged in parts of limited size."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(31))
    texts = [" ".join([word() for _ in range(20)] + [passage] + [word() for _ in range(20)]) for _ in range(400)]
    texts += [texts[0][:300], texts[1][90:], passage[5:210] + word() * 20]
    whole = repeats._compare

    def limited(rows):
        key = [c for c in ("rank", "place", "core", "salt") if c in rows]
        assert rows.groupby(key).size().max() <= 100, "a frame holds too many slices of one core"
        return whole(rows)

    monkeypatch.setattr(repeats, "_compare", limited)
    monkeypatch.setattr(repeats, "CROWD", 40, raising=False)
    check(spark, texts)


@pytest.mark.parametrize("rows", [1, 3, 50])
def test_crowded_ranks_agree_however_batches_are_cut(spark, monkeypatch, rows):
    monkeypatch.setattr(repeats, "CROWD", 2, raising=False)
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        check(spark, sample(11, 60))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)


def test_rows_that_share_an_id_or_have_none(spark):
    texts = sample(4, 50)
    check(spark, texts, [i // 2 if i % 9 else None for i in range(len(texts))])


def test_odd_rows_and_cut_texts(spark):
    df = docs_frame(spark, odd_rows(), extra=True)
    assert repeats.repeat_digests(df).count() == len(odd_rows())
    cut = repeats.remove_repeats(df)
    assert cut.columns == df.columns
    rows = cut.collect()
    assert sorted(str(r["text"]) for r in rows if r["doc_id"] in (5, 6)) == ["", ""]
    assert [r["text"] for r in rows if r["doc_id"] == 3] == [None]
    assert all(r["key"] == "own key" for r in rows)
    assert repeats.remove_repeats(df.limit(0)).count() == 0
    assert repeats.repeat_digests(df.limit(0)).count() == 0


def test_whole_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {r["doc_id"]: p for r, p in zip(docs, plain([r["text"] for r in docs]))}
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op9_suffix_dedup"](spark, sf).collect()} == want
