import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tributary.llm import common, lines
from tributary.llm.queries import LINES_SQL, QUERIES
from helpers import docs_frame, duck, odd_rows

WHITE = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs=2, min_chars=10):
    """(doc_id, kept text, lines, dropped) per row, by counting documents per key."""
    key = lambda line: line.strip(WHITE).translate(FOLD)
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                held[key(line)].add(i)
    low = {k: min(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if i is None or low.get(key(x), i) == i]
        out.append((i, None if t is None else "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=str)


def line_rows():
    rng = random.Random(9)
    pool = [f"shared line number {i}" for i in range(30)] + ["short", "", "   ", "ÄÖÜ grüße ÉÀ Ñandú", "äöü grüße éà ñandú",
                                                           "exactly 10", "only nine", "İstanbul'da bir gün", "i̇stanbul'da bir gün", "Kelvin K sign here"]
    dress = [str, str.upper, lambda s: f" \t{s}\x0b\r", lambda s: s + " ", lambda s: s.capitalize()]
    rows = []
    for i in range(300):
        text = "\n".join(rng.choice(dress)(rng.choice(pool)) if rng.random() < 0.4 else f"own line {i} {j} of its document"
                         for j in range(rng.randrange(12)))
        rows.append((i // 2 if i % 17 == 0 else i, text, "en", "s"))
    same = "\n".join(["every document begins like this"] * 3)
    return rows + [(1000 + i, same, "en", "s") for i in range(40)] + [
        (None, same, "en", "s"), (None, "exactly 10\nown words of nobody", None, None), (2000, "\n\n\n", "en", "s"),
        (2001, "a\r\nexactly 10\r\nb", "en", "s"), (2002, "many lines of one text\n" * 3000, "en", "s")]


def read(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)


@pytest.mark.parametrize("hot", [common.HOT, 1, 10**9])
def test_agrees_with_counting_documents_per_line(spark, monkeypatch, hot):
    """Also where every repeated line is joined by shuffle (1), or by broadcast."""
    monkeypatch.setattr(common, "HOT", hot)
    rows = odd_rows() + line_rows()
    out = lines.dedup_lines(docs_frame(spark, rows, extra=True).repartition(6))
    assert read(out) == plain([r[:2] for r in rows])
    assert all(r["key"] == "own key" and r["id"] == "own id" and r["rank"] == "own rank" for r in out.collect())


def test_thresholds_are_parameters(spark):
    rows = line_rows()
    df = docs_frame(spark, rows)
    for docs, chars in ((3, 10), (25, 1), (2, 30)):
        assert read(lines.dedup_lines(df, docs, chars)) == plain([r[:2] for r in rows], docs, chars)


def test_digests_agree_with_sql(spark):
    df = docs_frame(spark, odd_rows() + line_rows())
    got = sorted((tuple(r) for r in lines.digests(df).collect()), key=str)
    want = duck(LINES_SQL, documents=df.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    assert got == sorted((tuple(r.values()) for r in want), key=str)


def test_own_columns_stay_and_named_ones_are_replaced(spark):
    df = docs_frame(spark, odd_rows()).withColumn("gone", F.lit("g")).withColumn("row", F.lit("r")).withColumn("n_lines", F.lit("x"))
    out = lines.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "gone", "row", "n_lines", "n_dropped"]
    assert {(r["gone"], r["row"]) for r in out.collect()} == {("g", "r")}


def test_empty_table_and_native_plan(spark):
    empty = docs_frame(spark, [])
    assert lines.dedup_lines(empty).count() == 0 and lines.digests(empty).count() == 0
    out = QUERIES["op12_line_dedup"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
