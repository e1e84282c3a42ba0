import math

import pytest

from tributary.llm import mixing
from tributary.llm.queries import MIX_SQL, QUERIES
from helpers import docs_frame, duck, odd_rows


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Water filling, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 5, "b": 500, "c": 1, None: 40}, {None: 7},
                                   {f"s{i}": (i * 37) % 101 + 1 for i in range(12)}, {"a": 0, "b": 3}])
def test_targets_follow_the_stated_rounds(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    want = targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9)


def test_odd_rows_agree_with_sql_and_reruns(spark):
    df = docs_frame(spark, odd_rows(), extra=True)
    names = ["doc_id", "size", "source_size", "target", "taken"]
    run = lambda: sorted((tuple(r) for r in mixing.mix_sources(df, keep=["doc_id"]).select(*names).collect()), key=str)
    first = run()
    assert first == run()
    want = sorted((tuple(r[n] for n in names) for r in duck(MIX_SQL, documents=df.select("doc_id", "text", "source").toPandas())), key=str)
    assert [r[:3] + r[4:] for r in first] == [r[:3] + r[4:] for r in want]
    assert all(math.isclose(a[3], b[3]) for a, b in zip(first, want))
    assert all(r[4] <= 2 * r[1] for r in first)


def test_hot_source_comes_near_its_target(spark):
    rows = [(i, "word " * (1 + i % 50), "en", "hot" if i % 3 else f"s{i % 9}") for i in range(3000)]
    got = mixing.mix_sources(docs_frame(spark, rows)).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    for r in got:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 50


def test_empty_table_and_whole_query(spark):
    assert mixing.mix_sources(docs_frame(spark, [])).count() == 0
    got = QUERIES["op2_mix_sources"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
