"""Batching against plain-Python references."""

import random

from pyspark.sql import functions as F

from tributary.operators import batching as bt


def _feed(spark, n=2000, seed=3):
    rnd = random.Random(seed)
    seqs = rnd.sample(range(n * 5), n)   # sparse, unordered sequences
    rows = [(s, "i", f"d{rnd.randint(0, 20)}", "x" * rnd.randint(0, 300)) for s in seqs]
    return spark.createDataFrame(rows, "sequence bigint, index string, doc_id string, source string"), rows


def test_count_batches_exact_across_buckets(spark):
    df, rows = _feed(spark)
    got = bt.batch_by_count(df, 7, lane=bt.sequence_lane(3), bucket_width=512)
    got = {r["sequence"]: (r["lane"], r["batch_no"], r["batch_pos"]) for r in got.collect()}
    for lane in range(3):
        seqs = sorted(s for s, *_ in rows if s % 3 == lane)
        for p, s in enumerate(seqs):
            assert got[s] == (lane, p // 7, p % 7)


def _greedy(sizes, max_bytes, max_count):
    out, b, acc, cnt = [], 0, 0, 0
    for s in sizes:
        out.append((b, cnt))
        acc, cnt = acc + s, cnt + 1
        if acc >= max_bytes or cnt >= max_count:
            b, acc, cnt = b + 1, 0, 0
    return out


def test_byte_batches_match_brute_force(spark):
    df, rows = _feed(spark)
    # every third change shares its sequence with another of its lane and tick
    df = df.withColumn("sequence", F.when(F.col("sequence") % 3 == 0, F.floor(F.col("sequence") / 60) * 60)
                       .otherwise(F.col("sequence")).cast("bigint"))
    df = df.withColumn("timestamp", F.timestamp_seconds(F.floor(F.col("sequence") / 1200)))
    rows = [tuple(r) for r in df.select("sequence", "index", "doc_id", "source").collect()]
    for tick_ms, ticks in ((None, lambda s: None), (1000, lambda s: s // 1200)):
        got = bt.batch_by_bytes(df, max_bytes=2000, max_count=9, lane=bt.sequence_lane(2), tick_ms=tick_ms,
                                tie=("doc_id", "source")).collect()
        assert len(got) == len(rows)
        groups = {}
        for s, index, doc, src in rows:
            groups.setdefault((s % 2, ticks(s)), []).append((s, doc, src, len(src) + len(index) + len(doc) + 200))
        want = []
        for g, items in groups.items():
            items.sort()
            want += [(*g, s, doc, src, b, p) for (s, doc, src, _), (b, p) in zip(items, _greedy([i[3] for i in items], 2000, 9))]
        key = lambda r: tuple(str(x) for x in r)
        assert sorted([(r["lane"], r["tick"], r["sequence"], r["doc_id"], r["source"], r["batch_no"], r["batch_pos"])
                       for r in got], key=key) == sorted(want, key=key)


def test_flush_points_by_bytes_and_count():
    import numpy as np
    rnd = random.Random(1)
    for _ in range(50):
        sizes = [rnd.choice([0, 1, 5, 50, 500]) for _ in range(rnd.randrange(0, 60))]
        for limit, count in ((100, 7), (1, None), (10**9, 4), (300, None)):
            want = [i for i, (b, p) in enumerate(_greedy(sizes, limit, count or 10**9)) if p == 0]
            assert bt.flush_points(np.array(sizes, np.int64), limit, count).tolist() == want


def test_tick_batches(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00.05",), ("2024-01-01 00:00:00.15",), ("2024-01-01 00:00:00.19",)],
                               "ts string").select(F.col("ts").cast("timestamp").alias("timestamp"))
    ticks = [r["tick"] for r in bt.batch_by_tick(df, 100).collect()]
    assert ticks[1] == ticks[2] == ticks[0] + 1


def test_byte_batches_need_one_shuffle_and_go_on_over_record_batches(spark):
    df, rows = _feed(spark, 300)
    df = df.withColumn("timestamp", F.timestamp_seconds(F.floor(F.col("sequence") / 100)))
    # a change without a document id has no size; rows without a lane are never flushed
    df = df.withColumn("doc_id", F.when(F.col("sequence") % 5 != 4, F.col("doc_id")))
    lane = F.when(F.col("sequence") % 4 != 3, F.col("sequence") % 4)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    for tick_ms in (None, 1000):
        batched = bt.batch_by_bytes(df, max_bytes=900, max_count=4, lane=lane, tick_ms=tick_ms)
        plan = batched._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan and "FlatMapGroups" not in plan
        try:
            spark.conf.set(key, 7)
            got = {r["sequence"]: (r["lane"], r["batch_no"], r["batch_pos"]) for r in batched.collect()}
        finally:
            spark.conf.set(key, was)
        groups = {}
        for s, index, doc, src in sorted(rows):
            size = 0 if s % 5 == 4 else len(src) + len(index) + len(doc) + 200
            groups.setdefault((s % 4, tick_ms and s // 100), []).append((s, size))
        want = {}
        for (mod, _), items in groups.items():
            limits = (900, 4) if mod != 3 else (10**9, 10**9)
            for (s, _), at in zip(items, _greedy([z for _, z in items], *limits)):
                want[s] = (mod if mod != 3 else None, *at)
        assert got == want
