"""Stages in batches: retries, failures half way, limits, and how often a payload is parsed."""

import re

import pytest
from pyspark.sql import functions as F

from tributary.fixtures import changes, wire
from tributary.functions import codec
from tributary.operators import filters as flt
from tributary.operators.apply import KeyedTable, apply_changes
from tributary.plans import stages
from tributary.session import materialize, release, shared_dir
from tributary.sources import cursor as cur
from tributary.sources import storage

from conftest import SF_SMALL


def _cfg(**kw):
    return stages.SyncConfig(tenant="acme", source_id="events", **kw)


def _state(df):
    return sorted(map(tuple, df.select("index", "doc_id", "sequence", "source").collect()))


def test_fetched_in_batches_the_table_is_the_fold_of_the_feed(spark):
    feed, paths, cfg = changes(spark, SF_SMALL), stages.SyncPaths.fresh(spark), _cfg(fetch=60)
    for _ in range(3):
        stages.sync(spark, feed, cfg, paths)
    n = stages._read(spark, paths.log).count()
    assert n == 180
    first = feed.orderBy("sequence").limit(n)
    bad = stages._read(spark, paths.dlq).count()
    assert bad == 0
    assert _state(KeyedTable(spark, paths.target).read()) == _state(apply_changes(first))


def test_running_a_stage_again_adds_nothing(spark):
    feed, paths, cfg = changes(spark, SF_SMALL).limit(200), stages.SyncPaths.fresh(spark), _cfg()
    stages.sync(spark, feed, cfg, paths)

    def everything():
        return (_state(KeyedTable(spark, paths.target).read()), stages._read(spark, paths.results).count(),
                stages._read(spark, paths.gated).count(), stages._read(spark, paths.log).count())
    once = everything()
    stages.gate_stage(spark, paths, cfg)
    stages.write_stage(spark, paths, cfg)
    stages.sync(spark, feed, cfg, paths)                     # an empty poll
    assert everything() == once


def test_a_write_that_fails_before_its_results_is_done_again_once(spark, monkeypatch):
    feed, paths, cfg = changes(spark, SF_SMALL).limit(200), stages.SyncPaths.fresh(spark), _cfg()
    stages.watch(spark, feed, paths, cfg)
    stages.gate_stage(spark, paths, cfg)
    real = stages._write

    def failing(df, path, *rest):
        if path == paths.results:
            raise OSError("store away")
        return real(df, path, *rest)
    with monkeypatch.context() as m:
        m.setattr(stages, "_write", failing)
        with pytest.raises(OSError):
            stages.write_stage(spark, paths, cfg)
    res = stages.write_stage(spark, paths, cfg)
    assert res.agg(F.sum("success_count") + F.sum("failure_count")).first()[0] == 200
    assert len(KeyedTable(spark, paths.target).manifest()["batches"]) == 1
    assert _state(KeyedTable(spark, paths.target).read()) == _state(apply_changes(feed))


def test_a_lost_cursor_commit_publishes_the_same_batch_again(spark):
    feed, paths, cfg = changes(spark, SF_SMALL).limit(100), stages.SyncPaths.fresh(spark), _cfg()
    stages.watch(spark, feed, paths, cfg)
    storage.delete(spark, f"{paths.cursors}/batch=00000000")
    stages.watch(spark, feed, paths, cfg)
    assert stages._read(spark, paths.log).count() == 100


def test_each_payload_is_parsed_once(spark):
    plan = codec.valid(codec.decode(wire(spark, SF_SMALL)))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("from_json", plan)) == 1
    plan = codec.quarantine(codec.decode(wire(spark, SF_SMALL)))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("from_json", plan)) == 1


def test_each_body_is_parsed_once_and_other_filters_come_first(spark):
    chain = flt.FilterChain([flt.FieldFilter("k", "greater_than", 3), flt.FieldFilter("type", "equals", "click"),
                             flt.OperationFilter(exclude=("delete",)), flt.FieldFilter("meta.uid", "exists")])
    feed = materialize(changes(spark, SF_SMALL), "t/feed")
    for df in (flt.gate(feed, chain), flt.apply_chain(feed, chain)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall("parse_json|parseJson", plan)) == 1
    plan = flt.apply_chain(feed, chain)._jdf.queryExecution().executedPlan().toString()
    assert "delete" in plan.split("Generate explode")[1]                  # below the parse, at the scan
    assert flt.apply_chain(feed, chain).count() == feed.filter(chain.passes()).count() > 0


def test_published_log_prunes_by_subject(spark):
    feed, paths, cfg = changes(spark, SF_SMALL), stages.SyncPaths.fresh(spark), _cfg()
    log = stages.watch(spark, feed, paths, cfg)
    sub = flt.SubjectFilter("acme", ("es.acme.temp_view.>",))
    plan = log.filter(sub.index_hint())._jdf.queryExecution().executedPlan().toString()
    assert "StartsWith(index" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert {r["index"] for r in log.filter(sub.index_hint()).select("index").distinct().collect()} <= {"temp_view"}


def test_expired_days_go_and_reads_prune(spark):
    from datetime import datetime, timedelta
    from tributary.session import scratch_path
    from tributary.sources import retention
    newest = datetime(2031, 5, 10, 12)
    rows = [(i, newest - timedelta(hours=6 * i)) for i in range(40)]
    path = scratch_path(spark, "t/retained")
    retention.append(spark.createDataFrame(rows, "x int, timestamp timestamp"), path)
    kept = retention.read(spark, path, newest, 50)
    want = [i for i in range(40) if 6 * i < 50]
    assert sorted(r["x"] for r in kept.collect()) == want
    assert "day" in kept._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert len(retention.drop_expired(spark, path, newest, 50)) == 8
    assert min(storage.names(spark, path)) == "day=2031-05-08"
    assert sorted(r["x"] for r in retention.read(spark, path, newest, 50).collect()) == want


def test_copies_are_dropped_and_a_cluster_needs_a_shared_folder(spark):
    df = materialize(spark.range(5).toDF("x"), "t/copy")
    assert df.count() == 5
    path = df._materialized
    release(df)
    assert not storage.exists(spark, path)

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: Conf())
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
    with pytest.raises(RuntimeError):
        shared_dir(Session())


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_write_decodes_each_payload_once_and_carries_what_it_writes(spark, monkeypatch):
    feed, paths, cfg = changes(spark, SF_SMALL).limit(200), stages.SyncPaths.fresh(spark), _cfg(batch_size=5, tick_ms=60_000)
    stages.watch(spark, feed, paths, cfg)
    stages.gate_stage(spark, paths, cfg)
    plans, columns = [], []

    def seen(df, kind):
        plans.append(_plan(df))
        columns.append(df.columns)
        return materialize(df, kind)
    monkeypatch.setattr(stages, "materialize", seen)
    stages.write_stage(spark, paths, cfg)
    assert len(re.findall("from_json", plans[0])) == 1
    assert "headers" not in columns[0] and "msg_id" not in columns[0]
    assert _state(KeyedTable(spark, paths.target).read()) == _state(apply_changes(feed))


def test_a_store_parses_each_line_once(spark):
    from tributary.workloads.stages import _store
    body = '{"index":{"_id":"u1","_index":"a"}}\n{"k":1,"meta":{"index":2}}\n{"delete":{"_id":"u3","_index":"a"}}\n'
    requests = materialize(spark.createDataFrame([(0, 0, 0, body)], "lane int, tick bigint, batch_no bigint, body string"), "t/asked")
    answers = _store()(requests)
    assert len(re.findall("from_json", _plan(answers))) == 1
    items = re.findall(r'"status":(\d+)', answers.first()["body"])
    assert items == ["200", "400"]


def test_a_first_poll_meets_no_cursors_and_shuffles_nothing(spark):
    feed, paths = changes(spark, SF_SMALL), stages.SyncPaths.fresh(spark)
    polled = cur.poll_per_index(feed, stages._cursors(spark, paths), limit=None)
    plan = polled._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    stages.watch(spark, feed.filter("sequence < 50"), paths, _cfg())
    later = cur.poll_per_index(feed, stages._cursors(spark, paths), limit=None)
    cursor = feed.filter("sequence < 50").groupBy("index").agg(F.max("sequence").alias("c"))
    assert later.count() == feed.join(cursor, "index", "left").filter("c IS NULL OR sequence > c").count()
