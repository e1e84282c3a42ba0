"""Connected components over links between integer ids, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import drop_staged, staged


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links -> ``(id, component)``: each linked id with the smallest id it reaches.

    A round hangs every node's larger neighbours on its smallest one, then every
    node and its smaller neighbours on the smallest of those; links only ever
    move to smaller ends.  It is over when every component is a star around its
    smallest id, which links made by local unions often are from the start.
    Rounds grow with the logarithm of a component's size.  Minima are
    pre-aggregated before their shuffle, and the join that spreads them is one
    that Spark splits where a node has many links.
    """
    now = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "links")
    while not _stars(now):
        nxt = staged(_small_star(_large_star(now)), "links")
        drop_staged(now)
        now = nxt
    out = now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
    out._staged_path = now._staged_path              # so that drop_staged(out) removes the last round's copy
    return out


def _stars(links: DataFrame) -> bool:
    """Whether no node hangs on two others, or on one while others hang on it (links are distinct, ``a > b``)."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    tangled = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)")
    return not tangled.limit(1).count()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = links.groupBy("a").agg(F.min("b").alias("low"))            # a > b, so only this side has smaller ends
    # a node without smaller neighbours is its own minimum: its links stay as they are
    return (both.where("b > a").join(low, "a", "left")
            .select(F.col("b").alias("a"), F.coalesce("low", "a").alias("b"))
            .unionByName(low.select("a", F.col("low").alias("b"))))


def _small_star(links: DataFrame) -> DataFrame:
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    return (links.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(low.select("a", F.col("low").alias("b"))).distinct())
