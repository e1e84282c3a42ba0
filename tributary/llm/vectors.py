"""Operators 1 and 4: exact near-duplicate vectors, and nearest neighbours.

``near_duplicates`` is a metric range join.  Unit vectors at cosine ``c`` are
``sqrt(2 - 2c)`` apart.  Large labels get pivots, spread by farthest-first choice
over a bounded sample; a vector belongs to the cell of its nearest pivot ``p``.
A vector ``v`` within the radius ``r`` of a vector of cell ``q`` obeys
``d(v, q) <= d(v, p) + 2r`` by the triangle inequality, and lies at most ``r``
beyond the plane halfway between the pivots; it is copied to every such cell of
smaller number than its own, so each pair meets in exactly one cell.  Cells
join on their own, a large one as pairs of blocks; a task gives link counts
and a root per linked vector, never pairs.  Equal vectors are one, with their
number as weight.

``nearest`` is a block matrix join.  Query blocks meet vector blocks; a tile
multiplies both as 8-bit integers (exact in floating point), bounds the error by
the norms of what rounding lost, and computes again in double precision,
summed in the order of the dimensions, only the pairs that can still be among
a query's best.  A heap keeps each query's best of a tile; a ranking merges the
tiles, so the result is exact.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part (in ``near_duplicates`` they are rows without links, as
are rows with a null label); vectors of different lengths never match; rows
that share an id are one vertex, and each row of ``nearest``'s table is a
candidate; ties go to the smaller id; empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import drop_staged, staged
from tributary.llm.graph import components

#: Vectors a cell should have, and pivots a label gets at most.
CELL = 2048
PIVOTS = 64
#: Labels that get pivots (the largest), and sampled vectors per pivot.
SPLIT_LABELS = 256
SAMPLE_PER_PIVOT = 4
#: Vectors of a task's side in the join of a cell.
BLOCK = 2048
QUERY_BLOCK, VECTOR_BLOCK = 1024, 4096


def usable(vector: Column) -> Column:
    """True for vectors with only finite components, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(column) -> np.ndarray:
    x = np.array(column.tolist(), np.float64)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _gaps(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared distances of unit vectors."""
    return np.maximum(2.0 - 2.0 * (x @ pivots.T), 0.0)


def choose_pivots(x: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first choice of ``n`` rows."""
    chosen, near = [0], _gaps(x, x[:1])[:, 0]
    while len(chosen) < min(n, len(x)):
        at = int(near.argmax())
        chosen.append(at)
        near = np.minimum(near, _gaps(x, x[at:at + 1])[:, 0])
    return x[chosen]


def _pivots(reps: DataFrame) -> dict:
    """Pivots of the largest labels by ``(label, dimension)``: at most SPLIT_LABELS * PIVOTS vectors."""
    big = (reps.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL)
           .orderBy(F.col("n").desc(), "label", "dim").limit(SPLIT_LABELS).collect())
    if not big:
        return {}
    want = {(r["label"], r["dim"]): min(PIVOTS, -(-r["n"] // CELL)) for r in big}
    rate = F.lit(0.0)
    for r in big:
        k = (r["label"], r["dim"])
        rate = F.when((F.col("label") == k[0]) & (F.col("dim") == k[1]),
                      F.lit(SAMPLE_PER_PIVOT * want[k] / r["n"])).otherwise(rate)
    draw = F.crc32(F.concat_ws(":", F.lit("pivot"), F.col("id").cast("string")).cast("binary")) / F.lit(2.0**32)
    sample = reps.where(draw < rate).select("label", "dim", "id", "vector").toPandas().sort_values("id")
    return {k: choose_pivots(_units(rows["vector"]), want[k]) for k, rows in sample.groupby(["label", "dim"])}


def _cells(reps: DataFrame, radius: float) -> DataFrame:
    """Every representative in its home cell, and copied to the cells its radius reaches."""
    pivots = reps.sparkSession.sparkContext.broadcast(_pivots(reps))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for key, rows in b.groupby(["label", "dim"]):
                own = pivots.value.get(key)
                if own is None:
                    yield rows.assign(cell=np.int32(0), home=True)
                    continue
                gap = _gaps(_units(rows["vector"]), own)
                dist, home = np.sqrt(gap), gap.argmin(axis=1)
                near = dist[np.arange(len(rows)), home]
                apart = np.maximum(np.sqrt(_gaps(own, own))[home], 1e-12)
                beyond = (gap - near[:, None] ** 2) / (2 * apart)      # to the plane between the pivots
                reach = (dist <= near[:, None] + 2 * radius + 1e-9) & (beyond <= radius + 1e-9)
                reach &= np.arange(len(own))[None, :] < home[:, None]
                reach[np.arange(len(rows)), home] = True
                row, cell = np.nonzero(reach)
                yield rows.iloc[row].assign(cell=cell.astype(np.int32), home=cell == home[row])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in reps.schema)
    return reps.mapInPandas(run, f"{kinds}, cell int, home boolean")


class _Roots:
    """Smallest reachable position among ``n``, as links come in."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def flat(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links between positions; only distinct pairs of roots are walked."""
        flat = self.flat()
        x, y = np.minimum(flat[a], flat[b]), np.maximum(flat[a], flat[b])
        pairs = np.unique(x[x != y] * len(flat) + y[x != y])
        for p in pairs.tolist():
            u, v = self.find(p // len(flat)), self.find(p % len(flat))
            self.parent[max(u, v)] = min(u, v)


def _join_block(rows: pd.DataFrame, threshold: float, same: bool, first: int) -> pd.DataFrame:
    """Links among the rows of one block, or between two: weighted counts and roots."""
    rows = rows.sort_values("id", kind="stable")
    x, weight, ids = _units(rows["vector"]), rows["weight"].to_numpy(), rows["id"].to_numpy()
    home, left = rows["home"].to_numpy(), rows["block"].to_numpy() == first
    right = left if same else ~left
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    count, roots = np.zeros(len(rows), np.int64), _Roots(len(rows))
    for i in range(0, len(a), 256):
        at = a[i:i + 256]
        hit = (x[at] @ x[b].T >= threshold) & (home[at][:, None] | home[b][None, :])
        if same:
            hit &= b[None, :] > at[:, None]
        r, c = np.nonzero(hit)
        np.add.at(count, at[r], weight[b[c]])
        np.add.at(count, b[c], weight[at[r]])
        roots.add(at[r], b[c])
    linked = np.flatnonzero(count)
    return pd.DataFrame({"id": ids[linked], "n": count[linked], "root": ids[roots.flat()[linked]]})


def near_duplicates(table: DataFrame, threshold: float = 0.98, vector: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``table``."""
    radius = float(np.sqrt(2 - 2 * threshold))
    rows = table.select("vec_id", "label", F.col(vector).alias("vector"))
    good = rows.where(usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    same = (good.groupBy("label", "vector")
            .agg(F.min("vec_id").alias("id"), F.count_distinct("vec_id").alias("weight")))
    reps = staged(same.select("label", F.size("vector").alias("dim"), "id", "weight", "vector"), "vectors")
    cells = staged(_cells(reps, radius), "vector-cells")
    drop_staged(reps)
    key = ["label", "dim", "cell"]
    sizes = cells.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = (cells.join(sizes, key)
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other")))

    def join(k, b):
        return _join_block(b, threshold, k[3] == k[4], k[3])

    parts = staged(placed.groupBy(*key, "first", "second").applyInPandas(join, "id long, n long, root long"), "vector-links")
    drop_staged(cells)
    counts = parts.groupBy("id").agg(F.sum("n").alias("n"))
    found = components(parts.select(F.col("id").alias("a"), F.col("root").alias("b")))
    group = good.join(same.withColumnRenamed("id", "rep"), ["label", "vector"]).select("vec_id", "rep", "weight")
    linked = (group.join(counts, F.col("rep") == F.col("id"), "left").drop("id")
              .join(found, F.col("rep") == F.col("id"), "left")
              .select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"),
                      F.coalesce("component", "rep").alias("component"))
              .groupBy("vec_id").agg(F.max("n").alias("n"), F.min("component").alias("component")))
    return (table.select("vec_id").join(linked, "vec_id", "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))


def _quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Integers of 8 bits (held as floats), scales, and norms of the rounded vectors and of the rest."""
    scale = np.abs(x).max(axis=1) / 127.0
    q = np.rint(x / scale[:, None])
    rounded = q * scale[:, None]
    kind = np.float32 if x.shape[1] <= 1024 else np.float64          # sums stay exact
    return q.astype(kind), scale, np.linalg.norm(rounded, axis=1), np.linalg.norm(x - rounded, axis=1)


def tile_best(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """``(query position, id, product)`` of each query's ``k`` best rows of a tile, its own id left out."""
    qq, qs, qn, qe = _quantised(q)
    xq, xs, xn, xe = _quantised(x)
    about = (qq @ xq.T).astype(np.float64) * qs[:, None] * xs[None, :]
    full = qn + qe
    off = full[:, None] * xe[None, :] + qe[:, None] * xn[None, :] + 1e-12 * full[:, None] * (xn + xe)[None, :]
    own = q_ids[:, None] == ids[None, :]
    low = np.where(own, -np.inf, about - off)
    if len(ids) > k:
        least = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k]
    else:
        least = np.full(len(q), -np.inf)
    r, c = np.nonzero((about + off >= least[:, None]) & ~own)
    score = np.zeros(len(r))
    for j in range(q.shape[1]):                                        # the order of a plain loop
        score += q[r, j] * x[c, j]
    out, cuts = [], np.searchsorted(r, np.arange(len(q) + 1))
    for i in range(len(q)):
        mine = slice(cuts[i], cuts[i + 1])
        best = heapq.nsmallest(k, zip((-score[mine]).tolist(), ids[c[mine]].tolist(), strict=True))
        out += [(i, e, -s) for s, e in best]
    return out


def nearest(table: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` nearest by inner product, exactly."""
    rows = table.select("vec_id", F.col(vector).alias("vector")).where(usable(F.col(vector)) & F.col("vec_id").isNotNull())
    rows = rows.withColumn("dim", F.size("vector"))
    queries = rows.where(is_query).dropDuplicates(["vec_id", "vector"])
    n_rows, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    row_blocks, query_blocks = -(-n_rows // VECTOR_BLOCK) or 1, -(-n_queries // QUERY_BLOCK) or 1
    here = F.xxhash64("vec_id", "vector")
    left = (queries.withColumn("qb", F.pmod(here, F.lit(query_blocks)).cast("int"))
            .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))))
    right = (rows.withColumn("cb", F.pmod(here, F.lit(row_blocks)).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))

    def join(q, x):
        out = []
        if len(q) and len(x):
            xs, ids = np.array(x["vector"].tolist(), np.float64), x["vec_id"].to_numpy()
            for i in range(0, len(q), QUERY_BLOCK):
                part = q.iloc[i:i + QUERY_BLOCK]
                qs, q_ids = np.array(part["vector"].tolist(), np.float64), part["vec_id"].to_numpy()
                for j in range(0, len(x), VECTOR_BLOCK):
                    at = slice(j, j + VECTOR_BLOCK)
                    out += [(i + p, e, s) for p, e, s in tile_best(qs, q_ids, xs[at], ids[at], k)]
        at = [o[0] for o in out]
        return pd.DataFrame({"query_id": q["vec_id"].to_numpy()[at] if out else np.zeros(0, np.int64),
                             "query": q["hash"].to_numpy()[at] if out else np.zeros(0, np.int64),
                             "vec_id": np.array([o[1] for o in out], np.int64),
                             "score": np.array([o[2] for o in out], np.float64)})

    left = left.withColumn("hash", here)
    best = left.groupBy("dim", "qb", "cb").cogroup(right.groupBy("dim", "qb", "cb")).applyInPandas(
        join, "query_id long, query long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
