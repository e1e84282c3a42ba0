"""Reconciliation by digests (J5): bodies are read only where tables differ.

A document's range is the leading bits of its key's hash; ``write_digested`` stores a
table by range, with each row's hashes beside its body, and a digest per range:
the number of rows and the exclusive or of their hashes, whatever their order.
A range's digest is that of its halves put together, so digests of wider ranges
need no rows.  ``differing_ranges`` compares from wide to narrow and follows only
what differs; ``reconcile_digested`` then reads rows of those ranges alone, by folder
and by file statistics, and counts the others as equal.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.apply import KEY, reconcile
from tributary.session import materialize

#: Leading bits of a range at each level, widest first; folders are named by the widest.
LEVELS = (6, 10, 14, 18)


def range_of(key: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - bits)


def _digest() -> list[Column]:
    return [F.sum("n").cast("bigint").alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")]


def write_digested(state: DataFrame, path: str, key: Sequence[str] = KEY, levels: Sequence[int] = LEVELS) -> None:
    """Store a keyed table (``key``, ``sequence``, ``source``) by range under ``path``, with its digests."""
    key, spark = list(key), state.sparkSession
    row = [*key, "sequence", "source"]
    rows = state.select(*row, range_of(key, levels[-1]).alias("leaf"), F.xxhash64(*row).alias("h1"),
                        F.xxhash64(F.lit("second"), *row).alias("h2"))
    rows = rows.withColumn("part", F.shiftrightunsigned("leaf", levels[-1] - levels[0]))
    rows.repartition("part").sortWithinPartitions("part", "leaf").write.mode("overwrite").partitionBy("part").parquet(f"{path}/rows")
    rows.limit(0).write.mode("overwrite").parquet(f"{path}/shape")        # columns of a table without rows
    written = spark.read.schema(rows.schema).parquet(f"{path}/rows").select("leaf", F.lit(1).alias("n"), "h1", "h2")
    written.groupBy("leaf").agg(*_digest()).write.mode("overwrite").parquet(f"{path}/digests")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/shape").schema).parquet(f"{path}/rows")


def differing_ranges(spark: SparkSession, a: str, b: str, levels: Sequence[int] = LEVELS) -> DataFrame:
    """Narrowest ranges in which the tables differ (column ``leaf``), level by level from the widest."""
    sides = [spark.read.parquet(f"{p}/digests") for p in (a, b)]
    differ = None
    for bits in levels:
        at = F.shiftrightunsigned("leaf", levels[-1] - bits)
        left, right = (s.withColumn("at", at) for s in sides)
        if differ is not None:                    # only below what differed one level up
            wider = F.shiftrightunsigned("leaf", levels[-1] - levels[levels.index(bits) - 1])
            left, right = (s.join(differ, wider == differ["up"], "left_semi") for s in (left, right))
        left, right = (s.groupBy("at").agg(*_digest()) for s in (left, right))
        other = right.select(F.col("at").alias("_at"), F.col("n").alias("_n"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"))
        same = F.struct("n", "h1", "h2").eqNullSafe(F.struct("_n", "_h1", "_h2"))
        met = left.join(other, F.col("at") == F.col("_at"), "full_outer").filter(~same | F.col("at").isNull() | F.col("_at").isNull())
        differ = materialize(met.select(F.coalesce("at", "_at").alias("up")), "stage/differing")
    return differ.withColumnRenamed("up", "leaf")


def rows_to_compare(spark: SparkSession, path: str, leaves: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """The rows of the differing ranges; folders without any are not opened."""
    shift = levels[-1] - levels[0]
    parts = [r[0] for r in leaves.select(F.shiftrightunsigned("leaf", shift)).distinct().collect()]      # at most 2 ** levels[0]
    low = F.col("part").isin(parts) if parts else F.lit(False)
    return _rows(spark, path).filter(low).join(leaves, "leaf", "left_semi")


def reconcile_digested(spark: SparkSession, target: str, expected: str, key: Sequence[str] = KEY,
                       levels: Sequence[int] = LEVELS) -> tuple[DataFrame, DataFrame]:
    """J5 as ``reconcile`` does it: the keys of differing ranges with their category, and how many others are equal."""
    leaves = differing_ranges(spark, target, expected, levels)
    t, e = (rows_to_compare(spark, p, leaves, levels) for p in (target, expected))
    equal = spark.read.parquet(f"{expected}/digests").join(leaves, "leaf", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))
    return reconcile(t, e, key), equal
