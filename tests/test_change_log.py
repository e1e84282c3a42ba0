"""The change log as a source and a sink of Spark's own: offsets, ties, restarts, epochs."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tributary.fixtures import changes
from tributary.session import scratch_path
from tributary.sources import change_log

from conftest import SF_SMALL


@pytest.fixture
def log(spark):
    change_log.register(spark)
    return scratch_path(spark, "t/log")


def save(df, path, epoch, **options):
    df.write.format("change_log").option("epoch", epoch).options(**options).mode("append").save(path)


def load(spark, path, **options):
    return spark.read.format("change_log").options(**options).load(path)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_reads_back_what_was_written_once(spark, log):
    c = changes(spark, SF_SMALL)
    save(c.repartition(3), log, "one")
    save(c.repartition(2), log, "one")                     # the same epoch again
    assert load(spark, log).schema == c.schema and same(load(spark, log), c)
    top = c.count()
    assert same(load(spark, log, start=100, end=top // 2, rows_per_task=50), c.filter((F.col("sequence") > 100) & (F.col("sequence") <= top // 2)))
    save(c.limit(0), log, "none")
    assert load(spark, log).count() == top


def test_stream_stops_resumes_and_keeps_ties_whole(spark, log):
    c = changes(spark, SF_SMALL).withColumn("sequence", F.floor(F.col("sequence") / 7))     # ties of seven
    top = c.agg(F.max("sequence")).first()[0]
    out, ckpt = scratch_path(spark, "t/out"), scratch_path(spark, "t/ckpt")
    seen = []

    def drain():
        s = spark.readStream.format("change_log").option("rows_per_batch", 200).option("rows_per_task", 100).load(log)
        q = s.writeStream.foreachBatch(lambda b, i: seen.append((i, b.groupBy("sequence").count().collect()))).option(
            "checkpointLocation", ckpt).trigger(processingTime="0 seconds").start()
        q.processAllAvailable()
        q.stop()
        q = spark.readStream.format("change_log").load(log).writeStream.format("change_log").option(
            "checkpointLocation", f"{ckpt}-sink").trigger(availableNow=True).start(out)
        q.awaitTermination()

    for i in range(2):
        save(c.filter(F.floor(F.col("sequence") * 2 / (top + 1)) == i).repartition(3), log, f"e{i}", rows_per_mark=64)
        drain()
    assert len({i for i, _ in seen}) == len(seen) > 3       # several micro-batches, none twice
    held = [r["sequence"] for _, rows in seen for r in rows]
    assert len(held) == len(set(held))                      # a sequence comes in one micro-batch only
    assert sum(r["count"] for _, rows in seen for r in rows) == c.count()
    assert same(load(spark, out), c)
    again = spark.readStream.format("change_log").option("start", top // 2).load(log)     # a new query seeks back
    q = again.writeStream.format("memory").queryName("sought").option("checkpointLocation", scratch_path(spark, "t/c")).trigger(
        availableNow=True).start()
    q.awaitTermination()
    assert spark.table("sought").count() == c.filter(F.col("sequence") > top // 2).count()


def test_nothing_shows_before_commit_and_a_retried_epoch_adds_nothing(spark, log, tmp_path):
    c = changes(spark, SF_SMALL).limit(50)
    rows = pa.Table.from_pandas(c.toPandas()).cast(to_arrow_schema(c.schema))
    path = str(tmp_path / "log")
    make = lambda: change_log.LogStreamWriter(c.schema, {"path": path, "writer": "w"})
    first, data = make(), lambda: len(list((tmp_path / "log" / "data").iterdir()))
    written = [first.write(iter(rows.slice(0, 20).to_batches())), first.write(iter(rows.slice(20).to_batches())), first.write(iter([]))]
    assert data() == 2 and change_log._epochs(path) == []   # the job died here: files, but no epoch names them
    second = make()
    again = [second.write(iter(rows.to_batches()))]
    second.commit(again, 7)
    assert load(spark, path).count() == 50
    late = make()
    late.commit(written, 7)                                 # the first attempt's commit after all
    assert load(spark, path).count() == 50 and data() == 1
    failed = [make().write(iter(rows.to_batches()))]
    make().abort([*failed, None], 8)
    assert load(spark, path).count() == 50 and data() == 1
    assert [f["rows"] for f in json.loads((tmp_path / "log" / "epochs" / "w-000000000007").read_text())["files"]] == [50]


def test_large_tasks_write_several_files_and_null_sequences_fail(spark, log, monkeypatch, tmp_path):
    monkeypatch.setattr(change_log, "FILE_ROWS", 30)
    c = changes(spark, SF_SMALL).limit(100)
    rows = pa.Table.from_pandas(c.toPandas()).cast(to_arrow_schema(c.schema))
    w = change_log.LogStreamWriter(c.schema, {"path": str(tmp_path / "log")})
    assert [f["rows"] for f in w.write(iter(rows.to_batches(max_chunksize=10))).files] == [30, 30, 30, 10]
    with pytest.raises(ValueError):
        w.write(iter(rows.set_column(0, "sequence", pa.nulls(100, pa.int64())).to_batches()))


def test_an_empty_log_needs_a_schema(spark, log):
    with pytest.raises(Exception, match="schema"):
        load(spark, log).count()
    assert spark.read.format("change_log").schema("sequence long").load(log).count() == 0


def test_a_micro_batch_does_not_go_through_the_whole_log_again(spark, log, monkeypatch, tmp_path):
    class Files(list):
        passes = 0

        def __iter__(self):
            Files.passes += 1
            return super().__iter__()

    c = spark.range(4000).selectExpr("id AS sequence", "'i' AS index")
    for i in range(4):
        save(c.filter(f"id % 4 = {i}"), log, f"e{i}", rows_per_mark=10)
    files = change_log._Files(log).refresh()
    files.files, Files.passes = Files(files.files), 0
    at, got = change_log.START, []
    while (to := files.refresh().upto(at, 60)) > at:
        got += [(r.after, r.upto) for r in files.ranges(at, to, 30)]
        at = to
    assert Files.passes == 0 and at == 3999
    assert got[0][0] == -1 and got[-1][1] == 3999 and all(a[1] == b[0] for a, b in zip(got, got[1:])) and len(got) > 60
    w = change_log.LogStreamWriter(c.schema, {"path": str(tmp_path / "log")})
    for i in range(3):
        w.commit([], i)
    monkeypatch.setattr(change_log, "_epochs", lambda path: pytest.fail("a commit lists the log's epochs"))
    w.commit([], 3)
    w.commit([], 3)
