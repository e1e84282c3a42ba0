"""Reconciliation by digests: same categories as comparing rows, and only differing ranges are read."""

import random

import pytest
from pyspark.sql import functions as F

from tributary.fixtures import attempts
from tributary.operators import digests, metrics
from tributary.operators.apply import reconcile
from tributary.session import scratch_path

from conftest import SF_SMALL

SCHEMA = "index string, doc_id string, sequence bigint, source string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("changes", [0, 1, 40, 2000])
def test_categories_agree_with_comparing_all_rows(spark, changes):
    rng = random.Random(changes)
    rows = [(f"i{i % 4}", f"d{i}", i, None if i % 50 == 0 else f'{{"v":{i}}}') for i in range(2000)]
    ours = {r[:2]: r for r in rows}
    for i in rng.sample(range(2000), changes):
        r, kind = rows[i], rng.randrange(4)
        if kind == 0:
            del ours[r[:2]]
        elif kind == 1:
            ours[r[:2]] = (*r[:2], r[2] - 1, r[3])
        elif kind == 2:
            ours[r[:2]] = (*r[:3], '{"v":"other"}')
        else:
            ours[(r[0], r[1] + "x")] = (r[0], r[1] + "x", r[2], r[3])
    a, b = table(spark, list(ours.values())), table(spark, rows)
    pa, pb = scratch_path(spark, "t/a"), scratch_path(spark, "t/b")
    digests.write_digested(a, pa)
    digests.write_digested(b, pb)
    got, equal = digests.reconcile_digested(spark, pa, pb)
    count = lambda df: {r["category"]: r["count"] for r in df.groupBy("category").count().collect()}
    found, want = count(got), count(reconcile(a, b))
    found["equal"] = found.get("equal", 0) + equal.first()["n"]
    assert found == want | {"equal": want.get("equal", 0)}
    leaves = digests.differing_ranges(spark, pa, pb)
    assert leaves.count() <= 2 * changes
    if changes == 1:
        read = digests.rows_to_compare(spark, pb, leaves)
        assert len(read.inputFiles()) >= 1 and read.count() <= 5        # a range's rows, not the table
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(part" in plan
    if changes == 0:
        assert digests.rows_to_compare(spark, pb, leaves).count() == 0


def test_empty_tables(spark):
    pa, pb = scratch_path(spark, "t/a"), scratch_path(spark, "t/b")
    digests.write_digested(table(spark, []), pa)
    digests.write_digested(table(spark, [("i", "d", 1, None)]), pb)
    got, equal = digests.reconcile_digested(spark, pa, pb)
    assert [r["category"] for r in got.collect()] == ["missing"] and equal.first()["n"] == 0


def test_rolled_up_sketches_equal_none_lost(spark):
    """Minutes to days: counts are exact and quantiles within the stated rank error; rows are not read again."""
    a = attempts(spark, SF_SMALL)
    minutes = metrics.latency_sketches(a, F.col("duration_ms"))
    path = scratch_path(spark, "t/sketches")
    minutes.write.parquet(path)
    whole = metrics.sketch_quantiles(metrics.roll_up(spark.read.parquet(path), "year"), (0.1, 0.5, 0.99)).collect()
    values = sorted(r[0] for r in a.select("duration_ms").collect())
    assert len(whole) == 1 and whole[0]["count"] == len(values)
    for q, p in ((0.1, "p10"), (0.5, "p50"), (0.99, "p99")):
        below, upto = sum(v < whole[0][p] for v in values), sum(v <= whole[0][p] for v in values)
        assert below / len(values) <= q + metrics.RANK_ERROR and upto / len(values) >= q - metrics.RANK_ERROR
