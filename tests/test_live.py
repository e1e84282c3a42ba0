"""Live documents: the last emission of each document is its state in the fold of all changes."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tributary.operators.apply import apply_changes
from tributary.session import scratch_path
from tributary.streaming import feeds, live

SCHEMA = "sequence long, index string, doc_id string, operation string, source string"


def body(rng, depth=2):
    return {rng.choice("abc"): body(rng, depth - 1) if depth and rng.random() < 0.5 else rng.choice([1, 2.50, "x", None, [1], {}])
            for _ in range(rng.randrange(3))}


@pytest.mark.parametrize("seed", [1, 2])
def test_shuffled_micro_batches_give_the_fold(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        op = rng.choice(["index", "update", "delete", "partial_update", "partial_update", "partial_update"])
        rows.append((i, f"i{i % 2}", f"d{rng.randrange(12)}", op, None if op == "delete" else json.dumps(body(rng))))
    c = spark.createDataFrame(rows, SCHEMA)
    src, out, ckpt = (scratch_path(spark, f"t/live-{k}") for k in ("src", "out", "ckpt"))
    order = list(range(300))
    rng.shuffle(order)
    parts = [order[:90], order[90:200], order[150:300]]                  # the last two overlap: changes come again
    for part in parts:
        c.filter(F.col("sequence").isin(part)).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 1).parquet(src)
    feeds.run(live.live_documents(stream), foreach_batch=feeds.append_updates(out), checkpoint=ckpt, output_mode="update")
    want = apply_changes(c).select("index", "doc_id", "sequence", "source")
    got = live.current_documents(spark.read.parquet(out))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_lapsed_tombstones_leave_the_state(spark):
    rows = [(5, "i", "d", "delete", None), (6, "i", "e", "index", "{}")]
    src, out, ckpt = (scratch_path(spark, f"t/ttl-{k}") for k in ("src", "out", "ckpt"))
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    q = feeds.start(live.live_documents(stream, keep_deletes_ms=1000), foreach_batch=feeds.append_updates(out), checkpoint=ckpt,
                    output_mode="update", trigger={"processingTime": "500 milliseconds"})
    deadline = time.time() + 90
    while time.time() < deadline and (q.lastProgress is None or q.lastProgress["batchId"] < 6):
        time.sleep(0.5)
    q.stop()
    held = lambda name: spark.read.format("statestore").option("stateVarName", name).load(ckpt).count()
    assert held("gone") == 0 and held("whole") == 1
    assert {(r["doc_id"], r["deleted"]) for r in spark.read.parquet(out).collect()} == {("d", True), ("e", False)}


def test_documents_share_groups_of_state(spark):
    n, big = 3 * live.BUCKETS, 2 ** 53 + 1
    rows = [(i, "i", f"d{i % n}", "partial_update" if i >= n else "index", json.dumps({"a": {f"k{i // n}": i}})) for i in range(2 * n)]
    rows += [(big, None, "d", "index", "{}"), (None, "i", "d0", "index", "{}"), (big + 2, "i", None, "delete", None)]
    src, out, ckpt = (scratch_path(spark, f"t/groups-{k}") for k in ("src", "out", "ckpt"))
    c = spark.createDataFrame(rows, SCHEMA)
    for part in (c.filter(F.col("sequence") >= n), c.filter("sequence IS NULL").unionByName(c.filter(F.col("sequence") < n))):
        part.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    feeds.run(live.live_documents(stream), foreach_batch=feeds.append_updates(out), checkpoint=ckpt, output_mode="update")
    state = spark.read.format("statestore").option("stateVarName", "whole").load(ckpt)
    assert state.count() == n + 1 and state.select("key").distinct().count() <= live.BUCKETS
    got = {(r["index"], r["doc_id"]): (r["sequence"], r["source"]) for r in live.current_documents(spark.read.parquet(out)).collect()}
    assert got == {("i", f"d{i}"): (n + i, f'{{"a":{{"k0":{i},"k1":{n + i}}}}}') for i in range(n)} | {(None, "d"): (big, "{}")}
