"""W2 in parallel and in a stream: the batches of walking a lane row by row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.fixtures import changes
from tributary.operators import batching as bt
from tributary.operators import cutting
from tributary.session import scratch_path
from tributary.streaming import batcher, feeds

from conftest import SF_SMALL


def walk(sizes, max_bytes, max_count):
    out, no, pos, held = [], 0, 0, 0
    for s in sizes:
        out.append((no, pos))
        held, pos = held + s, pos + 1
        if held >= max_bytes or (max_count and pos >= max_count):
            no, pos, held = no + 1, 0, 0
    return out


def rows(rng, lanes=3, n=900, huge=0.01, low=0):
    out = []
    for lane in range(lanes):
        sizes = rng.integers(low, 60, n if lane else n // 9)
        sizes[rng.random(len(sizes)) < huge] = 5000          # longer than whole chunks
        out += [(lane, int(i * 7), int(s)) for i, s in enumerate(sizes)]
    return out


@pytest.mark.parametrize("seed,max_bytes,max_count,chunk,low", [
    (1, 100, None, 100, 0), (2, 100, 4, 100, 0), (3, 500, 25, 700, 1), (4, 97, 3, 4000, 0), (5, 1, None, 64, 1), (6, 10**9, None, None, 0)])
def test_chunks_give_the_batches_of_a_walk(spark, seed, max_bytes, max_count, chunk, low):
    data = rows(np.random.default_rng(seed), low=low)
    df = spark.createDataFrame(data, "at int, sequence long, own int").repartition(5)
    got = cutting.batch_lanes_by_bytes(df, max_bytes, max_count, F.col("at"), size=F.col("own"), tie=(), chunk_bytes=chunk,
                                       bucket_width=500).collect()
    for lane in range(3):
        mine = sorted((r for r in got if r["lane"] == lane), key=lambda r: r["sequence"])
        want = [(s, size) for at, s, size in data if at == lane]
        assert [r["sequence"] for r in mine] == [s for s, _ in want]
        assert [(r["batch_no"], r["batch_pos"]) for r in mine] == walk([size for _, size in want], max_bytes, max_count)


def test_empty_feed_and_ties(spark):
    empty = changes(spark, SF_SMALL).limit(0)
    assert cutting.batch_lanes_by_bytes(empty).count() == 0
    c = changes(spark, SF_SMALL).withColumn("sequence", F.floor(F.col("sequence") / 3))
    a = cutting.batch_lanes_by_bytes(c, 3000, 20, bt.key_lane(2), chunk_bytes=6000, tie=("index", "doc_id", "timestamp"))
    b = bt.batch_by_bytes(c, 3000, 20, bt.key_lane(2), None, tie=("index", "doc_id", "timestamp")).drop("tick")
    assert a.count() == c.count() and a.select(*b.columns).exceptAll(b).count() == 0


def test_no_window_or_group_holds_a_lane(spark):
    """Rows meet by bucket or chunk; a lane as a whole is one row per bucket or chunk."""
    plan = cutting.batch_lanes_by_bytes(changes(spark, SF_SMALL), 4096, 25)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "_bucket" not in line.split("windowspecdefinition", 1)[-1] and "_chunk" not in line:
            raise AssertionError(line)


@pytest.mark.parametrize("cuts", [(0, 1000), (0, 7, 500, 501, 1000), (0, 333, 1000)])
def test_a_stream_cut_anyhow_gives_the_batches_of_the_table(spark, cuts):
    c = changes(spark, SF_SMALL)
    top = c.count()
    src, out, ckpt = (scratch_path(spark, f"t/buffer-{k}") for k in ("src", "out", "ckpt"))
    steps = [int(x * top / 1000) for x in cuts]
    stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1)
    for lo, hi in zip(steps, steps[1:]):
        c.filter((F.col("sequence") >= lo) & (F.col("sequence") < hi)).coalesce(1).write.mode("append").parquet(src)
        batches = batcher.batch_stream(stream.parquet(src), F.col("source"), bt.sequence_lane(4), 4096, 9, 86_400_000)
        feeds.run(batches, path=out, checkpoint=ckpt)          # stops and restarts after every cut
    done, left = spark.read.parquet(out), batcher.open_batches(spark, ckpt)
    assert {r[0] for r in done.select("flushed_by").distinct().collect()} <= {"limit", "tick"}
    cols = ["sequence", "lane", "tick", "batch_no", "batch_pos"]
    got = done.unionByName(left).select(*cols)
    want = bt.batch_by_bytes(c, 4096, 9, bt.sequence_lane(4), 86_400_000).select(*cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    last = c.agg(F.max("timestamp").alias("t")).select(bt.tick_of("t", 86_400_000)).scalar()
    assert left.filter(F.col("tick") < last).count() == 0      # what ended is flushed by its timer, not by later rows
