"""Keyed apply: sequential-replay oracle, idempotence, batch-order independence."""

import json
import random

from pyspark.sql import functions as F

from tributary.operators.apply import KeyedTable, apply_changes, latest_per_key, reconcile

SCHEMA = "sequence bigint, operation string, index string, doc_id string, source string"


def _random_feed(seed, n=300, keys=12):
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        op = rnd.choice(["index", "update", "delete", "partial_update", "partial_update"])
        body = None
        if op != "delete":
            body = json.dumps({f: rnd.choice([1, 2, "x", None, [1], {"n": 1}])
                               for f in rnd.sample(["a", "b", "c", "d"], rnd.randint(0, 3))})
        rows.append((seq, op, "i" + str(rnd.randint(0, 1)), "d" + str(rnd.randint(0, keys)), body))
    rnd.shuffle(rows)   # arrival order must not matter
    return rows


def _replay(rows):
    """Plain sequential replay by sequence (the oracle)."""
    state = {}
    for seq, op, index, doc, body in sorted(rows):
        k = (index, doc)
        if op in ("index", "update"):
            state[k] = (seq, json.loads(body))
        elif op == "delete":
            state.pop(k, None)
        else:
            cur = json.loads(json.dumps(state[k][1])) if k in state else {}
            _deep_merge(cur, json.loads(body))
            state[k] = (seq, cur)
    return state


def _as_state(df):
    return {(r["index"], r["doc_id"]): (r["sequence"], json.loads(r["source"])) for r in df.collect()}


def test_fold_matches_sequential_replay(spark):
    for seed in range(3):
        rows = _random_feed(seed)
        got = _as_state(apply_changes(spark.createDataFrame(rows, SCHEMA)))
        assert got == _replay(rows), seed


def _apply_batches(spark, df, parts):
    state = None
    for p in parts:
        state = apply_changes(p, state, keep_tombstones=True)
        state = spark.createDataFrame(state.collect(), state.schema)      # cut the plan
    return _as_state(state.filter(~F.col("deleted")))


def test_apply_in_batches_with_replays(spark):
    rows = _random_feed(42)
    df = spark.createDataFrame(rows, SCHEMA)
    parts = [df.filter((F.col("sequence") >= lo) & (F.col("sequence") < lo + 75)) for lo in (0, 75, 150, 225)]
    # in sequence order, with earlier batches delivered again in between
    got = _apply_batches(spark, df, [parts[0], parts[1], parts[0], parts[2], parts[1], parts[3], parts[2]])
    assert got == _replay(rows)


def test_batch_order_free_without_partials(spark):
    rows = [r for r in _random_feed(43) if r[1] != "partial_update"]
    df = spark.createDataFrame(rows, SCHEMA)
    parts = [df.filter(F.col("sequence") % 3 == i) for i in (2, 0, 1)]
    assert _apply_batches(spark, df, parts + parts[:1]) == _replay(rows)


def test_keyed_table_replay_is_noop(spark):
    rows = _random_feed(9, n=120)
    df = spark.createDataFrame(rows, SCHEMA)
    t = KeyedTable(spark)
    t.apply(df.filter(F.col("sequence") < 60))
    t.apply(df.filter(F.col("sequence") >= 60))
    once = _as_state(t.read())
    t.apply(df.filter(F.col("sequence") < 60))                            # stale replay
    assert _as_state(t.read()) == once == _replay(rows)


def test_latest_per_key_and_reconcile(spark):
    rows = [(1, "index", "i", "a", '{"x":1}'), (2, "delete", "i", "a", None), (3, "index", "i", "b", '{"y":1}'),
            (4, "update", "i", "b", '{"y":2}')]
    df = spark.createDataFrame(rows, SCHEMA)
    latest = {(r["doc_id"], r["sequence"]) for r in latest_per_key(df).collect()}
    assert latest == {("b", 4)}
    half = apply_changes(df.filter("sequence <= 3"))
    cats = {r["doc_id"]: r["category"] for r in reconcile(half, apply_changes(df)).collect()}
    assert cats == {"b": "stale"}             # "a" is deleted in both
    extra = apply_changes(df.filter("sequence <= 1"))
    cats = {r["doc_id"]: r["category"] for r in reconcile(extra, apply_changes(df)).collect()}
    assert cats == {"a": "extra", "b": "missing"}


def _rand_value(rnd, depth):
    r = rnd.random()
    if depth < 2 and r < 0.35:
        return {k: _rand_value(rnd, depth + 1) for k in rnd.sample(["x", "y", "z"], rnd.randint(0, 2))}
    return rnd.choice([1, 2, "s", None, [1, 2], True])


def _deep_merge(dst, src):
    for k, v in src.items():
        if isinstance(v, dict) and isinstance(dst.get(k), dict):
            _deep_merge(dst[k], v)
        else:
            dst[k] = json.loads(json.dumps(v))


def test_deep_merge_matches_recursive_replay(spark):
    for seed in range(3):
        rnd = random.Random(100 + seed)
        rows = []
        for seq in range(250):
            op = rnd.choice(["index", "update", "delete", "partial_update", "partial_update", "partial_update"])
            body = None
            if op != "delete":
                body = json.dumps({f: _rand_value(rnd, 0) for f in rnd.sample(["a", "b", "c"], rnd.randint(0, 3))})
            rows.append((seq, op, "i", "d" + str(rnd.randint(0, 8)), body))
        want = {}
        for seq, op, index, doc, body in sorted(rows):
            k = (index, doc)
            if op in ("index", "update"):
                want[k] = (seq, json.loads(body))
            elif op == "delete":
                want.pop(k, None)
            else:
                cur = json.loads(json.dumps(want[k][1])) if k in want else {}
                _deep_merge(cur, json.loads(body))
                want[k] = (seq, cur)
        got = _as_state(apply_changes(spark.createDataFrame(rows, SCHEMA)))
        assert got == want, seed


def test_deep_merge_on_target_in_batches(spark):
    rows = [(1, "index", "i", "a", '{"m":{"x":1,"y":{"p":1}},"t":5}'),
            (2, "partial_update", "i", "a", '{"m":{"y":{"q":2}}}'),
            (3, "partial_update", "i", "a", '{"m":{"x":{"n":1}},"t":{}}'),
            (4, "partial_update", "i", "a", '{"m":{"y":7}}')]
    df = spark.createDataFrame(rows, SCHEMA)
    first = apply_changes(df.filter("sequence <= 2"), keep_tombstones=True)
    first = spark.createDataFrame(first.collect(), first.schema)
    got = _as_state(apply_changes(df.filter("sequence > 2"), first))
    assert got == {("i", "a"): (4, {"m": {"x": {"n": 1}, "y": 7}, "t": {}})}


def _files(path):
    import os
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path.removeprefix("file:")) for f in names}


def test_a_batch_leaves_existing_files_alone_and_retries_add_nothing(spark):
    rows = _random_feed(21, n=200)
    df = spark.createDataFrame(rows, SCHEMA)
    t = KeyedTable(spark)
    t.apply(df.filter("sequence < 160"), "b1")
    before = _files(t.path)
    t.apply(df.filter("sequence >= 160"), "b2")
    after = _files(t.path)
    assert {k: after[k] for k in before} == before
    t.apply(df.filter("sequence >= 160"), "b2")                           # the same batch again
    assert _files(t.path) == after
    assert _as_state(t.read()) == _replay(rows)
    assert _as_state(t.read(version=1)) == _replay([r for r in rows if r[0] < 160])


def test_late_changes_give_the_state_of_one_run_in_order(spark):
    rows = _random_feed(22, n=240)
    df = spark.createDataFrame(rows, SCHEMA)
    t = KeyedTable(spark)
    for i in (2, 0, 3, 1):
        t.apply(df.filter(F.col("sequence") % 4 == i))
    assert _as_state(t.read()) == _replay(rows)
    t.compact()
    assert t.manifest()["batches"] == {}
    assert _as_state(t.read()) == _replay(rows)


def test_nothing_shows_before_the_manifest(spark, monkeypatch):
    import pytest
    from tributary.operators import apply as module
    df = spark.createDataFrame([(1, "index", "i", "a", '{"x":1}'), (2, "index", "i", "a", '{"x":2}')], SCHEMA)
    t = KeyedTable(spark)
    t.apply(df.filter("sequence = 1"), "b1")

    def broken(*a):
        raise OSError("store away")
    with monkeypatch.context() as m:
        m.setattr(module.storage, "publish_text", broken)
        with pytest.raises(OSError):
            t.apply(df.filter("sequence = 2"), "b2")
        with pytest.raises(OSError):
            t.compact()
    assert _as_state(t.read()) == {("i", "a"): (1, {"x": 1})}
    t.apply(df.filter("sequence = 2"), "b2")
    assert _as_state(t.read()) == {("i", "a"): (2, {"x": 2})}
    with monkeypatch.context() as m:
        m.setattr(module.storage, "names", broken)
        with pytest.raises(OSError):                                      # an unreachable store is not an empty table
            t.read()


def test_writers_that_collide_both_get_in(spark):
    df = spark.createDataFrame([(i, "index", "i", f"d{i}", '{"x":1}') for i in range(4)], SCHEMA)
    a = KeyedTable(spark)
    b = KeyedTable(spark, a.path)
    a.apply(df.filter("sequence = 0"))
    stale, first = b.manifest(), []

    def late(m, real=b.manifest):                                         # b decides on an old version once
        first.append(1)
        return stale if len(first) == 1 else real()
    a.apply(df.filter("sequence = 1"))
    b.manifest = lambda version=None: late(version)
    b.apply(df.filter("sequence = 2"), "late")
    assert set(_as_state(a.read())) == {("i", "d0"), ("i", "d1"), ("i", "d2")}
    a.compact()
    a.apply(df.filter("sequence = 3"))
    a.vacuum(keep=1)
    assert len(_as_state(KeyedTable(spark, a.path).read())) == 4
    assert len(a.versions()) == 1


def test_text_of_numbers_and_characters_is_kept(spark):
    rows = [(1, "index", "i", "a", '{"n":1.0,"big":12345678901234567890.10,"s":"é\\u0041 \\"q\\"","m":{"k":1e2,"l":[1.50,null]}}'),
            (2, "partial_update", "i", "a", '{"m":{"z":-0.0}}'), (3, "partial_update", "i", "b", "not json"),
            (4, "index", "i", "c", ' {"kept" : 1.0 } ')]
    got = {r["doc_id"]: r["source"] for r in apply_changes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["a"] == '{"big":12345678901234567890.10,"m":{"k":1e2,"l":[1.50,null],"z":-0.0},"n":1.0,"s":"éA \\"q\\""}'
    assert got["b"] == "{}"
    assert got["c"] == ' {"kept" : 1.0 } '
