"""Operator 2: mix sources to target weights by Pareto order sampling (DataFrame functions only).

A source of ``size`` words and target ``T`` takes ``floor(T / size)`` certain
whole copies of every document; the words still missing are a fixed-size sample
of whole documents with unequal inclusion odds: each document's random odds
``u / (1 - u)`` are divided by its inclusion odds, and documents are taken in
that order until the missing words are reached.  Inclusion odds follow the
document's size against its source's mean, held within ``ODDS_RANGE``, so long
documents come early and the cut falls among short ones.  ``u`` comes from
an MD5 of the document id, so reruns agree.

No source is sorted in one task: the order value is cut into ``BINS`` bins,
sums per bin locate the bin of the cut, and only that bin's rows are ordered.

Defined cases: null or empty texts have size 0 and take 0; a null source is a
source of its own, last in order; repeated rows share a draw and are ordered by
id and size; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import WORD, staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2
BINS = 4096
ODDS_RANGE = (0.25, 4.0)
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """``(source, source_size)`` -> its weight and target in words.

    Sources in code point order, null last, weigh ``weights`` in turn.  Targets
    are ``min(cap, level * weight)``: in order of cap / weight, a source is capped
    while the level left for it and the rest is at least its own ratio.  The
    input has one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * float(max_copies)
    s = sizes.withColumn("weight", w).withColumn("cap", cap)
    everything = Window.partitionBy()
    ratio = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * float(share)
    s = s.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(rest))
    s = s.withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    level = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return s.select("source", "source_size", F.col("weight"),
                    F.when(level.isNull(), F.col("cap"))
                    .otherwise(F.least(F.col("cap"), level * F.col("weight"))).alias("target"))


def mix_sources(docs: DataFrame, size: Column | None = None, weights=WEIGHTS, share: float = SHARE,
                max_copies: int = MAX_COPIES, odds_weight: Column | None = None,
                seed: str = SEED, keep: list[str] | None = None) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` to each row of ``docs``.

    ``odds_weight`` (over ``size`` and ``mean_size``) scales a document's odds of
    inclusion within its source; ``keep`` names the columns of ``docs`` to carry.
    """
    keep = keep or docs.columns
    own = F.struct(*[F.col(c) for c in keep]).alias("_doc")
    lo, hi = ODDS_RANGE
    tilt = odds_weight if odds_weight is not None else F.greatest(F.lit(lo), F.least(
        F.lit(hi), F.col("size") / F.col("mean_size")))
    sized = staged(docs.select(own, F.col("doc_id").alias("_id"), F.col("source"),
                               (size if size is not None else word_count(F.col("text"))).alias("size")), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.avg("size").alias("mean_size"))
    plan = (source_targets(totals.select("source", "source_size"), weights, share, max_copies)
            .join(totals.select(F.col("source").alias("_s"), "mean_size"),
                  F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                        .otherwise(F.lit(0.0)))
            .withColumn("certain", F.floor("ratio").cast("long"))
            .withColumn("missing", F.col("target") - F.col("certain") * F.col("source_size"))
            .select(F.col("source").alias("_s"), "source_size", "mean_size", "target", "certain", "missing",
                    (F.col("ratio") - F.col("certain")).alias("part")))
    plan = staged(plan, "mix-plan")
    # the draw: random odds over inclusion odds, mapped to (0, 1) without changing the order
    u = (F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("_id").cast("string"), F.lit("null")),
                                              F.lit(seed)).cast("binary")), 1, 12), 16, 10).cast("double")
         + F.lit(0.5)) / F.lit(float(2**48))
    odds = F.col("part") / (F.lit(1.0) - F.col("part")) * tilt
    drawn = (sized.join(plan, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
             .withColumn("_u", u)
             .withColumn("_q", F.when((F.col("size") > 0) & (F.col("part") > 0) & (F.col("missing") > 0),
                                      F.col("_u") / (F.lit(1.0) - F.col("_u")) / odds))
             .withColumn("_v", F.col("_q") / (F.lit(1.0) + F.col("_q")))
             .withColumn("_bin", F.floor(F.col("_v") * BINS).cast("int")).drop("_u", "_q"))
    drawn = drawn.withColumn("_source", F.struct("source"))
    bins = (drawn.where(F.col("_bin").isNotNull()).groupBy("_source", "_bin", "missing")
            .agg(F.sum("size").alias("words")))
    run = Window.partitionBy("_source").orderBy("_bin")
    bins = bins.withColumn("upto", F.sum("words").over(run))
    cut = (bins.where((F.col("upto") >= F.col("missing")) & (F.col("upto") - F.col("words") < F.col("missing")))
           .select(F.col("_source").alias("_cs"), F.col("_bin").alias("_cut"),
                   (F.col("missing") - (F.col("upto") - F.col("words"))).alias("_left")))
    cut = staged(cut, "mix-cut")
    placed = (drawn.join(cut, F.col("_source") == F.col("_cs"), "left").drop("_cs"))
    # rows before the cut are in, rows after it out; only the cut's own bin is put in order
    edge = F.coalesce(F.col("_bin") == F.col("_cut"), F.lit(False))
    inside = Window.partitionBy("_source", "_bin").orderBy("_v", "_id", "size")
    near = (placed.where(edge)
            .withColumn("_upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
            # the row that crosses the line is in when that comes nearer to it
            .withColumn("_in", (F.col("_upto") - F.col("_left")) <= (F.col("_left") - (F.col("_upto") - F.col("size"))))
            .drop("_upto"))
    far = placed.where(~edge).withColumn(
        "_in", F.coalesce((F.col("_bin") < F.col("_cut")) | F.col("_cut").isNull(), F.lit(False)) & F.col("_bin").isNotNull())
    copies = F.col("certain") + F.col("_in").cast("long")
    out = near.unionByName(far).select("_doc.*", "size", "source_size", "target",
                                       copies.alias("copies"), (copies * F.col("size")).alias("taken"))
    return out
