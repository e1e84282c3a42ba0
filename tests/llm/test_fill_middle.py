import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tributary.llm import fill_middle as fim
from tributary.llm.queries import FILL_SQL, QUERIES
from helpers import docs_frame, duck, odd_rows

NAMES = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def plain(doc_id, text, seed=1):
    """Cut by slicing."""
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}")
    return (doc_id, n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}")


def special_rows():
    rng = random.Random(4)
    letters = "ab<>PSM \n\r $\\{}1é́ß𝒳😀"
    rows = [(100 + i, "".join(rng.choice(letters) for _ in range(rng.randrange(60))), "en", "s") for i in range(400)]
    long = "😀x" * (fim.RUN * 2) + "end"
    return rows + [(600 + i, t, None, None) for i, t in enumerate(
        ["<P>", "a <S> b", "<M", "P>", "<", long, long[:fim.RUN], long[:fim.RUN - 1], long[:fim.RUN + 1], "\x00", "$1 \\2"])]


def test_agrees_with_slicing_and_restores_every_text(spark):
    rows = odd_rows() + special_rows()
    out = fim.fill_in_middle(docs_frame(spark, rows, extra=True))
    got = out.select(*NAMES, fim.restored(F.col("output"), F.col("form")).alias("back"), "score", "text", "id").collect()
    want = [plain(r[0], r[1]) for r in rows]
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert all(r["back"] == (r["text"] or "") and r["score"] == "own score" and r["id"] == "own id" for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_digests_agree_with_sql(spark):
    df = docs_frame(spark, [r for r in odd_rows() + special_rows() if "\x00" not in (r[1] or "")])
    got = sorted((tuple(r) for r in fim.digests(df).collect()), key=str)
    want = duck(FILL_SQL, documents=df.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    assert got == sorted((tuple(r.values()) for r in want), key=str)


@pytest.mark.parametrize("share,forms", [(0, {"plain"}), (100, {"psm"})])
def test_shares_are_parameters(spark, share, forms):
    df = docs_frame(spark, [(i, "some text", "en", "a") for i in range(50)])
    assert {r["form"] for r in fim.fill_in_middle(df, 7, share, 0).collect()} == forms


def test_new_columns_replace_those_of_their_name(spark):
    df = docs_frame(spark, odd_rows()).withColumn("n", F.lit("old")).withColumn("form", F.lit("old"))
    out = fim.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert {r["form"] for r in out.collect()} <= {"plain", "psm", "spm"}


def test_empty_table_and_no_shuffle(spark):
    empty = docs_frame(spark, [])
    assert fim.fill_in_middle(empty).count() == 0 and fim.digests(empty).count() == 0
    out = QUERIES["op11_fill_in_middle"](spark, "/root/testdata/sf0.001")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
