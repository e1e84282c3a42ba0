"""Patterns matched by a trie in a table agree with matching each by itself."""

import random
import re

from tributary.operators.filters import subject_regex
from tributary.operators.subscriptions import match_subjects, pattern_trie, subscribe
from pyspark.sql import functions as F


def test_agrees_with_one_regex_per_pattern(spark):
    rng = random.Random(3)
    words, wild = ["es", "acme", "app_click", "", "*", "index", "a/b", ">"], ["es", "acme", "app_click", "", "*", "*", ">", "index", "a/b", "app*"]
    subjects = {".".join(rng.choice(words) for _ in range(rng.randrange(1, 6))) for _ in range(250)} | {"", "es", ".", ".."}
    patterns = {".".join(rng.choice(wild) for _ in range(rng.randrange(1, 6))) for _ in range(400)} | {"", ">", "*", "es.>", "es.>.tail"}
    s = spark.createDataFrame([(x,) for x in [*subjects, *list(subjects)[:40], None]], "subject string")
    p = spark.createDataFrame([(x,) for x in [*patterns, *list(patterns)[:40], None]], "pattern string")
    got = {tuple(r) for r in match_subjects(s, p).collect()}
    assert got == {(a, b) for a in subjects for b in patterns if re.match(subject_regex(b).replace("\\z", "\\Z"), a)}


def test_rows_come_once_per_pattern_and_plans_hold_no_regex(spark):
    rows = spark.createDataFrame([(i, "es.acme.app.index" if i % 2 else "es.other.x.delete") for i in range(20)], "n int, at string")
    p = spark.createDataFrame([(x,) for x in ("es.acme.>", "es.*.*.index", "es.*.x.*", "no")], "pattern string")
    out = subscribe(rows, p, F.col("at"))
    assert out.groupBy("pattern").count().collect() and sorted((r["n"], r["pattern"]) for r in out.collect()) == sorted(
        [(i, q) for i in range(20) for q in (("es.acme.>", "es.*.*.index") if i % 2 else ("es.*.x.*",))])
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "rlike" not in plan and "cartesian" not in plan
    assert subscribe(rows, p.limit(0), F.col("at")).count() == 0 and subscribe(rows.limit(0), p, F.col("at")).count() == 0


def test_shared_prefixes_are_shared_nodes(spark):
    p = spark.createDataFrame([(f"es.acme.{i % 3}.u{i}",) for i in range(300)], "pattern string")
    edges, ends = pattern_trie(p)
    assert edges.count() == 2 + 3 + 300 and ends.count() == 300


def test_subjects_are_shuffled_where_they_meet_many_edges_only(spark, monkeypatch):
    from tributary.operators import subscriptions
    shuffled = []

    def seen(df, kind):
        if kind == "stage/trie-level":
            plan = df._jdf.queryExecution().executedPlan().toString()
            shuffled.append("SortMergeJoin" in plan or "ShuffledHashJoin" in plan)
        return copy(df, kind)

    copy = subscriptions.materialize
    monkeypatch.setattr(subscriptions, "materialize", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        subjects = spark.range(5000).selectExpr("concat('es.acme.i', id % 5, '.index.u', id) AS subject")
        wide = spark.createDataFrame([("es.*.*.*.*",), (">",)], "pattern string")
        own = subjects.selectExpr("regexp_replace(subject, '.index.', '.*.') AS pattern")
        got = match_subjects(subjects, own.unionByName(wide))
        assert got.count() == 3 * 5000 and got.distinct().count() == 3 * 5000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffled == [False, False, False, False, False, True]
