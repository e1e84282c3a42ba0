import numpy as np
from pyspark.sql import functions as F

from tributary.llm import vectors
from tributary.llm.queries import NEAREST_SQL, NEAR_SQL, QUERIES
from helpers import duck

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def sample(n=700, d=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, d))
    rows = []
    for i in range(n):
        if rng.random() < 0.3:
            v = rng.normal(size=d)
        else:
            c = centres[rng.integers(40) if rng.random() < 0.6 else 0]
            v = c + rng.normal(size=d) * rng.choice([0.0, 0.05, 0.12, 0.2])
        rows.append((i * 2, [float(x) for x in (v * rng.choice([1.0, 3.0])).astype(np.float32)], int(rng.integers(3)), "own"))
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * d, [nan] * d, [1.0] * (d - 1) + [inf], [1.0] * (d - 1) + [None], [1.0, 2.0, 3.0], [2.0, 4.0, 6.0]]
    rows += [(5001 + 20 * i, v, 1, "own") for i, v in enumerate(odd)]
    rows += [(6000, rows[0][1], None, "own"), (6001, rows[0][1], rows[0][2], None), (6001, rows[0][1], rows[0][2], None)]
    return rows


def plain_product(x, y):
    """One addition after the other (``sum`` compensates for rounding)."""
    out = 0.0
    for a, b in zip(x.tolist(), y.tolist()):
        out += a * b
    return out


def plain_links(rows, threshold=0.98):
    good = [(i, np.array(v, float), l) for i, v, l, _ in rows
            if v and l is not None and None not in v and np.isfinite(v).all() and any(v)]
    links, low = {}, {}
    for i, a, l in good:
        for j, b, m in good:
            if i != j and l == m and len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                links.setdefault(i, set()).add(j)
    low = {i: i for i, *_ in rows}
    while True:
        new = {i: min([low[i], *(low[j] for j in links.get(i, ()))]) for i in low}
        if new == low:
            return links, low
        low = new


def test_links_agree_with_all_pairs(spark, monkeypatch):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    links, low = plain_links(rows)
    assert max(map(len, links.values())) > 30
    for cell, block in ((10_000, 10_000), (20, 10_000), (20, 17)):
        monkeypatch.setattr(vectors, "CELL", cell)
        monkeypatch.setattr(vectors, "BLOCK", block)
        got = vectors.near_duplicates(df).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r["n_links"] == len(links.get(r["vec_id"], ()))
            assert r["component_id"] == low[r["vec_id"]]
            assert r["kept"] == (r["vec_id"] == low[r["vec_id"]])


def test_nearest_agree_with_plain_products(spark, monkeypatch):
    rows = sample(seed=2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    good = [(i, np.array(v, float)) for i, v, _, _ in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    for q_block, block in ((1024, 4096), (16, 50)):
        monkeypatch.setattr(vectors, "QUERY_BLOCK", q_block)
        monkeypatch.setattr(vectors, "VECTOR_BLOCK", block)
        got = {}
        for r in vectors.nearest(df, F.col("vec_id") % 20 == 0, 5).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        queries = {i: v for i, v in good if i % 20 == 0}
        assert got.keys() == queries.keys()
        for q, v in queries.items():
            want = sorted((-plain_product(v, x), i) for i, x in good if i != q and len(x) == len(v))[:5]
            assert got[q] == [(i, -s) for s, i in want]


def test_tiles_with_huge_and_tiny_components():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8)) * 10.0 ** rng.integers(-20, 20, size=(300, 1))
    best = vectors.tile_best(x[:20], np.arange(20), x, np.arange(300), 3)
    for i in range(20):
        s = [(-plain_product(x[i], x[j]), j) for j in range(300) if j != i]
        assert [(e, v) for p, e, v in best if p == i] == [(j, -v) for v, j in sorted(s)[:3]]


def test_ties_go_to_the_smaller_id_and_empty_tables(spark):
    rows = [(20, [1.0, 0.0], 1, "")] + [(i, [2.0, float(i % 2)], 1, "") for i in range(1, 12)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = vectors.nearest(df, F.col("vec_id") % 20 == 0, 4).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(i, i, 2.0) for i in (1, 2, 3, 4)]
    assert vectors.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_whole_queries_agree_with_sql(spark):
    sf = "/root/testdata/sf0.001"
    pdf = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    for name, sql in (("op1_embedding_near_dedup", NEAR_SQL), ("op4_nearest_neighbours", NEAREST_SQL)):
        got = QUERIES[name](spark, sf)
        want = duck(sql, embeddings=pdf)
        assert sorted(map(str, (tuple(r[c] for c in got.columns) for r in got.collect()))) == sorted(
            str(tuple(r[c] for c in got.columns)) for r in want)
