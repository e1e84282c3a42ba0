"""Operator 13: vector codes from ball k-means codebooks, exact in whole numbers.

Components become ``floor(scale * x)``; a vector is cut in ``parts`` equal parts,
each position with a codebook of its own.  Each round assigns every part to its
nearest entry and replaces the entries by the floored means of their parts.

*Balls.*  An entry and the parts it holds are a ball.  The ball's radius, grown
by how far its entry moved, defines its neighbour entries: those within twice
the radius; no other entry can be nearer to any of its parts.  If neither the
entry nor a neighbour moved, the ball is settled and its parts need no work.
Else a part's distance to its own entry is worked out.  Within half the distance
to the closest neighbour lies the stable core: these parts stay.  The others
lie in rings: a part at distance ``r`` is compared with the neighbours that are at
most ``2 r`` from its entry, the nearest first, and with no others.  Comparisons
are on whole numbers, so ties and results are those of comparing with all entries.

*On Spark.*  Rows carry their whole-number vector, entries and distances through
a table per round in the shared folder; tasks sum up parts per entry before a
grouped sum.  The driver holds codebooks and neighbour lists only: ``entries`` x
dimension and ``parts`` x ``entries`` ** 2 numbers, whatever the table's size.

Defined cases: rows whose vector is null or holds null or non-finite components
are dropped; the table's dimension is that of the smallest kept ``vec_id``, and
rows of another are dropped; a dimension that ``parts`` doesn't divide is cut as
evenly as whole numbers allow; rows that share an id are rows of their own, ties
for the first codebook go by the vector; null ids come last; fewer rows than
``entries`` make a smaller codebook; whole numbers are held within +-2**29 /
sqrt(dimension), so that distances fit 64 bits; empty tables give empty results;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import drop_staged, join_counted, staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Parts of a ball that are compared at a time.
BLOCK = 1024
_STATE = "q array<int>, code array<int>, near array<bigint>"


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows."""
    width, far = x.shape[1], max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if width * 4 * far * far < 2**53:                 # every step is exact in floating point
        f, g = x.astype(np.float64), c.astype(np.float64)
        return ((f * f).sum(1)[:, None] + (g * g).sum(1) - 2 * (f @ g.T)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in c], axis=1)


@dataclass
class Book:
    """Entries of one part position, each with its neighbours in order of distance."""

    entries: np.ndarray
    #: per entry: neighbours, their squared distances, and whether its ball is settled
    near: list[np.ndarray]
    gaps: list[np.ndarray]
    settled: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray, radius: np.ndarray | None = None, moved: np.ndarray | None = None) -> "Book":
        """``radius`` of each ball around its entry (none yet: any), ``moved`` entries."""
        k = len(entries)
        gap, near, gaps, settled = squared(entries, entries), [], [], np.zeros(k, bool)
        for i in range(k):
            order = np.lexsort((np.arange(k), gap[i]))
            order = order[order != i]
            if radius is not None:
                reach = 4.0 * radius[i] ** 2 * (1 + 1e-9) + 1
                order = order[gap[i][order] <= reach]
                settled[i] = not (moved[i] or moved[order].any())
            near.append(order.astype(np.int32))
            gaps.append(gap[i][order])
        return cls(entries, near, gaps, settled)

    def assign(self, x: np.ndarray, code: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row and its squared distance, from the entries of the round before."""
        code, far = code.copy(), far.copy()
        work = np.flatnonzero(~self.settled[code])
        far[work] = ((x[work] - self.entries[code[work]]) ** 2).sum(1)
        core = np.array([g[0] if len(g) else np.iinfo(np.int64).max for g in self.gaps])
        work = work[4 * far[work] >= core[code[work]]]
        work = work[np.argsort(code[work], kind="stable")]
        for rows in np.split(work, np.flatnonzero(np.diff(code[work])) + 1):
            if len(rows):
                self._rings(x, int(code[rows[0]]), rows, code, far)
        return code, far

    def _rings(self, x, entry: int, rows, code, far) -> None:
        ring = np.searchsorted(self.gaps[entry], 4 * far[rows], "right")
        order = np.argsort(ring, kind="stable")
        for at in range(0, len(rows), BLOCK):
            some = order[at:at + BLOCK]
            r, n = rows[some], ring[some]
            rivals = self.near[entry][:n[-1]]
            gap = squared(x[r], self.entries[rivals])
            gap[np.arange(len(rivals)) >= n[:, None]] = np.iinfo(np.int64).max
            low = gap.min(1)
            best = np.where(gap == low[:, None], rivals, len(self.entries)).min(1)
            better = (low < far[r]) | ((low == far[r]) & (best < entry))
            code[r[better]], far[r[better]] = best[better], low[better]


def _matrix(column: pa.Array, width: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _lists(values: np.ndarray, kind) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(values.ravel(), kind))


def _assigned(rows: DataFrame, books, cuts) -> DataFrame:
    """Rows with the entries and distances of a round."""
    shared, k = rows.sparkSession.sparkContext.broadcast(books), len(cuts) - 1
    keep = rows.columns[:-3]

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            q, code, far = (_matrix(b.column(len(keep) + i), w) for i, w in enumerate((cuts[-1], k, k)))
            for p, book in enumerate(shared.value):
                code[:, p], far[:, p] = book.assign(q[:, cuts[p]:cuts[p + 1]], code[:, p], far[:, p])
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep) + 1], _lists(code, pa.int32()), _lists(far, pa.int64())],
                                             names=[*keep, "q", "code", "near"])

    return rows.mapInArrow(run, rows.schema)


def _sums(rows: DataFrame, size: int, cuts) -> list:
    """Per part position and entry: parts, largest squared distance and component sums."""
    k = len(cuts) - 1

    def run(batches):
        n, far = np.zeros((k, size), np.int64), np.zeros((k, size), np.int64)
        sums = np.zeros((size, cuts[-1]), np.int64)
        for b in batches:
            q, code, near = (_matrix(b.column(i), w) for i, w in enumerate((cuts[-1], k, k)))
            for p in range(k):
                n[p] += np.bincount(code[:, p], minlength=size)
                np.maximum.at(far[p], code[:, p], near[:, p])
                np.add.at(sums[:, cuts[p]:cuts[p + 1]], code[:, p], q[:, cuts[p]:cuts[p + 1]])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "n": n[part, entry],
            "far": far[part, entry], "sums": pa.array([sums[e, cuts[p]:cuts[p + 1]] for p, e in zip(part, entry)],
                                                      pa.list_(pa.int64()))})

    made = rows.select("q", "code", "near").mapInArrow(run, "part int, entry int, n bigint, far bigint, sums array<bigint>")
    flat = made.select("part", "entry", "n", "far", F.posexplode("sums").alias("pos", "x"))
    return flat.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.max("far").alias("far"), F.sum("x").alias("x")).collect()


def _updated(books, sums, cuts) -> list[Book]:
    """Entries at the floored means of their parts, with the balls they have then."""
    out = []
    for p, book in enumerate(books):
        entries, radius = book.entries.copy(), np.zeros(len(book.entries))
        for r in sums:
            if r["part"] == p:
                entries[r["entry"], r["pos"]] = r["x"] // r["n"]
                radius[r["entry"]] = math.sqrt(r["far"])
        shift = np.sqrt(((entries - book.entries) ** 2).sum(1).astype(np.float64))
        out.append(Book.of(entries, radius + shift, shift > 0))
    return out


@dataclass
class Coded:
    """Rows with ``code`` (entry per part) and ``near`` (squared distance per part), and the codebooks."""

    rows: DataFrame
    books: list[np.ndarray]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()


def whole_numbers(table: DataFrame, vector: str, scale: int) -> tuple[DataFrame, int]:
    """Usable vectors of the table's dimension with their whole numbers ``q``, and that dimension."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = table.where(F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), vector).select(F.size(vector).alias("n")).first()
    dim = first["n"] if first else 0
    bound = math.isqrt(2**58 // max(dim, 1))
    whole = F.transform(vector, lambda x: F.greatest(F.lit(-bound), F.least(F.lit(bound), F.floor(
        F.greatest(F.lit(-2.0**40), F.least(F.lit(2.0**40), x.cast("double") * scale))))).cast("int"))
    return kept.where(F.size(vector) == dim).withColumn("q", whole), dim


def encode_vectors(table: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
                   rounds: int = ROUNDS, scale: int = SCALE) -> Coded:
    """Codes of every usable vector of ``table`` (columns ``vec_id``, ``label`` and ``vector``)."""
    rows, dim = whole_numbers(table.select("vec_id", "label", F.col(vector).alias("_vector")), "_vector", scale)
    zeros = lambda kind: F.array_repeat(F.lit(0).cast(kind), parts)
    now = staged(rows.select("vec_id", "label", "q", zeros("int").alias("code"), zeros("bigint").alias("near")), "vector-codes")
    cuts = [dim * p // parts for p in range(parts + 1)]
    first = now.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    start = np.array([r["q"] for r in first], np.int64).reshape(len(first), dim)
    if not len(start):
        return Coded(now, [start[:, cuts[p]:cuts[p + 1]] for p in range(parts)])
    books = [Book.of(start[:, cuts[p]:cuts[p + 1]]) for p in range(parts)]
    for step in range(rounds + 1):
        nxt = staged(_assigned(now, books, cuts), "vector-codes")
        drop_staged(now)
        now = nxt
        if step < rounds:
            books = _updated(books, _sums(now, len(start), cuts), cuts)
    return Coded(now, [b.entries for b in books])


def code_table(table: DataFrame) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every kept row."""
    coded = encode_vectors(table)
    digits = [F.lpad(F.lower(F.hex(F.get("code", p))), 2, "0") for p in range(PARTS)]
    error = F.aggregate("near", F.lit(0).cast("bigint"), lambda s, x: s + x)
    rows = coded.rows.select("vec_id", "label", F.concat(*digits).alias("code"), error.alias("error"))
    whole = F.least(F.sum(F.col("error").cast("decimal(19,0)")), F.lit(2**63 - 1)).cast("bigint")
    labels = staged(rows.groupBy("label").agg(whole.alias("label_error"), F.count(F.lit(1)).alias("n")), "vector-labels")
    return join_counted(rows, labels, ["label"], "n").select(
        "vec_id", "code", "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256"))
