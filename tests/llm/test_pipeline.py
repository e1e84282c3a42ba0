import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tributary.llm import mixing, stages
from helpers import docs_frame, odd_rows
from test_ngram_join import plain as plain_groups
from test_repeats import plain as plain_repeats

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == names
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))


def test_stages_on_odd_rows_and_empty_tables(spark):
    df = docs_frame(spark, odd_rows(), extra=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns
        assert all(r["score"] == "own score" for r in out.collect())
        assert stage(spark, df.limit(0), SF).count() == 0
    ids = lambda d: sorted((r["doc_id"] for r in d.collect()), key=str)
    assert ids(stages.known_language(spark, df, SF)) == sorted([1, 1, 2, 5, 6, None, 8, 10], key=str)
    assert ids(stages.one_of_each_group(spark, df, SF)) == sorted([1, 3, 4, 5, 7, 8, 9, 10, None], key=str)
    assert len(ids(stages.without_repeats(spark, df, SF))) == len(odd_rows())
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, df, SF).count() == len(odd_rows())
    assert last(spark, df.limit(0), SF).count() == 0


def test_near_copies_between_the_two_rules_go(spark):
    """Copies under 90% of three-word shingles but at or over 80% of five-word ones, against counting shared shingles."""
    rng = random.Random(6)
    texts = []
    for k in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        edits = list(base)
        for i in range(20, 400, 50):                     # 8 of 400 words, one in 50
            edits[i] = f"x{k}"
        more = base + [f"y{rng.randrange(10**6)}" for _ in range(60)]
        far = list(base)
        for i in range(10, 400, 30):                     # one in 30: under 80% of five-word shingles
            far[i] = f"z{k}"
        texts += [" ".join(t) for t in (base, base[:340], edits, more, far)]
    low = plain_groups(texts, 80, 5)[1]
    kept = sorted(i for i in range(len(texts)) if low[i] == i)
    assert kept == sorted([5 * k for k in range(12)] + [5 * k + 4 for k in range(12)])
    assert plain_groups(texts)[1] == list(range(len(texts)))            # op3's rule links none of them
    df = docs_frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).repartition(4)
    assert sorted(r["doc_id"] for r in stages.one_of_each_group(spark, df, SF).collect()) == kept


def test_whole_pipeline_agrees_with_plain_stages(spark):
    """Every decision worked out again from the rows alone, but for the language (its own test) and the draw."""
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    rows = [r for r in rows if any(c.isalpha() for c in r["text"] or "")]
    low = plain_groups([r["text"] for r in rows], 80, 5)[1]
    rows = [r for i, r in enumerate(rows) if low[i] == i]
    data = [r["text"].encode() for r in rows]
    seen = Counter(t[i:i + 200] for t in data for i in range(len(t) - 199))
    for r, t in zip(rows, data):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i:i + 200] = True
        r["text"] = bytes(b for b, g in zip(t, gone) if not g).decode("utf-8", "ignore")
    cut = docs_frame(spark, [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows])
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(cut).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((r["doc_id"], library.encode(r["text"], add_special_tokens=False).ids)
                  for r in rows for _ in range(copies[r["doc_id"]]))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], list(r["ids"])) for r in got) == want


def test_all_documents_stay_where_no_language_can_be_learned(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    for df in (docs_frame(spark, [(i, t, None, s) for i, t, _, s in odd_rows()], extra=True),
               docs_frame(spark, [(held, "the only labelled row is held out", "en", "a"), (held + 1, "no label here", None, "a")])):
        out = stages.known_language(spark, df, SF)
        assert out.columns == df.columns
        assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_plain_rules_agree_on_lengths():
    assert plain_repeats(["a" * 200, "b"])[0][:2] == (200, 0)
