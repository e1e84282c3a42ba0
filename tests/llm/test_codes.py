import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import codes
from tributary.llm.queries import QUERIES, codes_sql
from helpers import duck

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Every part against every entry, in Python's whole numbers."""
    kept = sorted(((i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows
                   if v is not None and all(x is not None and math.isfinite(x) for x in v)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(kept[0][1]) if kept else 0
    kept = [r for r in kept if len(r[1]) == dim]
    cuts = [dim * p // parts for p in range(parts + 1)]
    q = np.array([r[1] for r in kept], object).reshape(len(kept), dim)
    books = [[list(v[cuts[p]:cuts[p + 1]]) for v in q[:entries]] for p in range(parts)]

    def assign():
        out = []
        for p in range(parts):
            x, c = q[:, cuts[p]:cuts[p + 1]], np.array(books[p], object).reshape(len(books[p]), -1)
            gap = np.array([[sum((a - b) ** 2 for a, b in zip(v, e)) for e in c] for v in x], object).reshape(len(x), len(c))
            best = [min(range(len(c)), key=lambda j: (g[j], j)) for g in gap]
            out.append((best, [g[j] for g, j in zip(gap, best)]))
        return out

    for _ in range(rounds):
        for p, (best, _) in enumerate(assign()):
            for j in set(best):
                own = [q[i, cuts[p]:cuts[p + 1]] for i in range(len(q)) if best[i] == j]
                books[p][j] = [sum(c) // len(own) for c in zip(*own)]
    last = assign()
    error = [sum(last[p][1][i] for p in range(parts)) for i in range(len(q))]
    total = {}
    for r, e in zip(kept, error):
        total[r[2]] = total.get(r[2], 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{last[p][0][i]:02x}" for p in range(parts)), error[i], total[r[2]], sha)
                   for i, r in enumerate(kept)), key=str)


def vectors(n=700, dim=8, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * 0.1
    x[::3] = x[0]                                    # a third of all rows are one vector
    rows = [(int(i), [float(c) for c in v], None if i % 11 == 0 else int(i % 3 != 0)) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    return rows + [(2000, None, 1), (2001, [nan] + [0.0] * (dim - 1), 1), (2002, [inf] * dim, None), (2003, [None] + [1.0] * (dim - 1), 1),
                   (2004, [0.0] * dim, 1), (2005, [1.0], 1), (2006, [], 0), (5, x[7].tolist(), 2), (5, x[7].tolist(), 2), (None, x[9].tolist(), 2)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def read(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def test_agrees_with_comparing_all_entries(spark):
    rows = vectors()
    assert read(codes.code_table(frame(spark, rows).repartition(5))) == plain(rows)


@pytest.mark.parametrize("n,dim,scale", [(300, 6, 1.0), (40, 8, 1.0), (300, 4, 40000.0), (12, 3, 1.0)])
def test_small_tables_uneven_parts_and_large_components(spark, n, dim, scale):
    rows = [(i, None if v is None else [None if c is None else c * scale for c in v], lab) for i, v, lab in vectors(n, dim, 7)]
    assert read(codes.code_table(frame(spark, rows))) == plain(rows)


def test_huge_components_are_held_at_the_bound(spark):
    bound = math.isqrt(2**58 // 4)
    got = codes.encode_vectors(frame(spark, [(1, [1e300, -1e300, 0.5, -0.0001], 1), (2, [0.0] * 4, 1)])).rows.collect()
    assert {r["vec_id"]: list(r["q"]) for r in got} == {1: [bound, -bound, 512, -1], 2: [0] * 4}
    assert all(r["near"] == [0] * 4 for r in got)


def test_settled_balls_cores_and_rings_leave_the_result_alone():
    rng = np.random.default_rng(1)
    x = rng.integers(-40, 40, (3000, 3))
    entries = x[:60].copy()
    code, far = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    book, compared = codes.Book.of(entries), []
    measure = codes.squared
    for step in range(12):
        codes.squared = lambda a, b: compared.append(len(a) * len(b)) or measure(a, b)
        try:
            code, far = book.assign(x, code, far)
        finally:
            codes.squared = measure
        gap = ((x[:, None, :] - book.entries) ** 2).sum(2)
        assert (code == gap.argmin(1)).all() and (far == gap.min(1)).all()
        entries = np.array([x[code == j].sum(0) // (code == j).sum() if (code == j).any() else book.entries[j] for j in range(60)])
        radius = np.array([math.sqrt(far[code == j].max(initial=0)) for j in range(60)])
        shift = np.sqrt(((entries - book.entries) ** 2).sum(1))
        book = codes.Book.of(entries, radius + shift, shift > 0)
    assert book.settled.any()
    assert sum(compared[-5:]) < 0.2 * 5 * len(x) * 60        # late rounds compare with few entries


def test_agrees_with_sql(spark):
    rows = [r for r in vectors(350, 8, 3) if r[1] is None or len(r[1]) == 8]
    rows = [(100000 + k if r[0] is None or r[0] == 5 and k > 5 else r[0], *r[1:]) for k, r in enumerate(rows)]
    df = frame(spark, rows)
    pdf = df.toPandas().astype({"label": "Int64"})
    assert read(codes.code_table(df)) == sorted((tuple(r.values()) for r in duck(codes_sql(), embeddings=pdf)), key=str)


def test_floats_nulls_only_and_empty_tables(spark):
    df = frame(spark, vectors(60)).select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"), "label",
                                          F.lit(1).alias("code"), F.lit(2).alias("q"), F.lit(3).alias("near"))
    assert codes.code_table(df).count() == 64
    assert codes.code_table(df.limit(0)).count() == 0
    assert codes.code_table(frame(spark, [(1, None, 1), (2, None, None)])).count() == 0
    assert codes.code_table(frame(spark, [(1, [], 1), (2, [], None)])).count() == 2
    out = QUERIES["op13_vector_codes"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
