"""Keyed apply queries: latest state (W4), partial fold (W5), apply in
batches (J2, K6) and reconciliation (J5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.fixtures import changes
from tributary.functions import jsonpath
from tributary.operators import digests
from tributary.operators.apply import KeyedTable, apply_changes, latest_per_key, reconcile
from tributary.session import scratch_path
from tributary.streaming import feeds, live
from tributary.workloads.registry import register


def typed_state(df):
    """Typed reads of the state body (engine-neutral output for the oracle)."""
    body = jsonpath.parse_body("source")
    g = lambda p, t: F.try_variant_get(jsonpath.field(body, p), "$", t)
    return df.select("index", "doc_id", "sequence", g("k", "bigint").alias("k"), g("type", "string").alias("type"),
                     g("value", "double").alias("value"), F.to_json(jsonpath.field(body, "flag")).alias("flag"),
                     g("meta.uid", "bigint").alias("uid"), g("meta.tags.1", "string").alias("tag1"),
                     F.size(F.map_keys(body.try_cast("map<string,variant>"))).alias("n_keys"))


_W4_SQL = """SELECT index, doc_id, sequence, operation, source FROM (
  SELECT *, row_number() OVER (PARTITION BY index, doc_id ORDER BY sequence DESC) AS rn FROM changes) t
  WHERE rn = 1 AND operation <> 'delete'"""


@register("w4_latest_state", _W4_SQL)
def w4_latest_state(spark, sf_dir):
    return latest_per_key(changes(spark, sf_dir))


def _state_sql(src: str) -> str:
    """The folded state of the change set ``src`` (an SQL relation), typed."""
    return f"""
SELECT r.index, r.doc_id, r.last_seq AS sequence, f.k, f.type, f.value, f.flag, f.uid, f.tag1, f.n_keys
FROM (SELECT index, doc_id,
        max(sequence) FILTER (WHERE operation <> 'partial_update') AS reset_seq,
        arg_max(operation, sequence) FILTER (WHERE operation <> 'partial_update') AS reset_op,
        max(sequence) FILTER (WHERE operation = 'partial_update') AS last_partial,
        max(sequence) AS last_seq
      FROM {src} GROUP BY index, doc_id) r
LEFT JOIN (
  SELECT index, doc_id,
    arg_max(TRY_CAST(json_extract(source, '$.k') AS BIGINT), sequence) FILTER (WHERE json_exists(source, '$.k')) AS k,
    arg_max(json_extract_string(source, '$.type'), sequence) FILTER (WHERE json_exists(source, '$.type')) AS type,
    arg_max(TRY_CAST(json_extract(source, '$.value') AS DOUBLE), sequence) FILTER (WHERE json_exists(source, '$.value')) AS value,
    arg_max(json_extract(source, '$.flag')::VARCHAR, sequence) FILTER (WHERE json_exists(source, '$.flag')) AS flag,
    arg_max(TRY_CAST(json_extract(source, '$.meta.uid') AS BIGINT), sequence) FILTER (WHERE json_exists(source, '$.meta')) AS uid,
    arg_max(json_extract_string(source, '$.meta.tags[1]'), sequence) FILTER (WHERE json_exists(source, '$.meta')) AS tag1,
    CAST(4 + CAST(count(*) FILTER (WHERE json_exists(source, '$.flag')) > 0 AS INTEGER) AS INTEGER) AS n_keys
  FROM (SELECT c.* FROM {src} c JOIN (
          SELECT index, doc_id, max(sequence) FILTER (WHERE operation <> 'partial_update') AS reset_seq
          FROM {src} GROUP BY index, doc_id) rr USING (index, doc_id)
        WHERE c.operation <> 'delete' AND c.sequence >= coalesce(rr.reset_seq, -1)) live
  GROUP BY index, doc_id) f USING (index, doc_id)
WHERE r.reset_op IN ('index', 'update') OR r.last_partial > coalesce(r.reset_seq, -1)"""


_FOLD_SQL = _state_sql("changes")


@register("w5_partial_fold", _FOLD_SQL)
def w5_partial_fold(spark, sf_dir):
    return typed_state(apply_changes(changes(spark, sf_dir)))


def _mid(c):
    return F.floor(F.coalesce(c.agg(F.max("sequence")).scalar(), F.lit(0)) / 2)


@register("j2_apply_merge", _FOLD_SQL)
def j2_apply_merge(spark, sf_dir):
    c = changes(spark, sf_dir)
    mid = _mid(c)
    first = apply_changes(c.filter(F.col("sequence") < mid), keep_tombstones=True)
    second = apply_changes(c.filter(F.col("sequence") >= mid), target=first)
    return typed_state(second)


_HALF = "(SELECT * FROM changes WHERE sequence < (SELECT max(sequence) // 2 FROM changes))"


@register("j5_reconcile", f"""
SELECT CASE WHEN t.sequence IS NULL THEN 'missing' WHEN e.sequence IS NULL THEN 'extra'
            WHEN t.sequence <> e.sequence THEN 'stale' ELSE 'equal' END AS category,
       CAST(count(*) AS BIGINT) AS n
FROM ({_state_sql(_HALF)}) t FULL OUTER JOIN ({_FOLD_SQL}) e ON t.index = e.index AND t.doc_id = e.doc_id
GROUP BY 1""")
def j5_reconcile(spark, sf_dir):
    c = changes(spark, sf_dir)
    target = apply_changes(c.filter(F.col("sequence") < _mid(c)))
    rec = reconcile(target, apply_changes(c))
    return rec.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@register("j5_digest_reconcile", f"""
SELECT CASE WHEN doc_id LIKE '%77' THEN 'missing' WHEN doc_id LIKE '%5' AND sequence % 50 = 1 THEN 'stale'
            WHEN doc_id LIKE '%8' AND sequence % 60 = 2 THEN 'different' ELSE 'equal' END AS category, CAST(count(*) AS BIGINT) AS n
FROM ({_W4_SQL}) s GROUP BY 1
UNION ALL SELECT 'extra', CAST(count(*) AS BIGINT) FROM ({_W4_SQL}) s WHERE sequence % 100 = 4 HAVING count(*) > 0""")
def j5_digest_reconcile(spark, sf_dir):
    """A copy of the latest state with planted differences, compared by digests of key ranges."""
    state = latest_per_key(changes(spark, sf_dir)).select("index", "doc_id", "sequence", "source")
    seq, doc = F.col("sequence"), F.col("doc_id")
    stale, other = doc.endswith("5") & (seq % 50 == 1), doc.endswith("8") & (seq % 60 == 2)
    copy = state.filter(~doc.endswith("77")).select(
        "index", "doc_id", F.when(stale, seq - 1).otherwise(seq).alias("sequence"), F.when(other, F.lit("{}")).otherwise(F.col("source")).alias("source"))
    extra = state.filter(seq % 100 == 4).select("index", F.concat(F.lit("not-"), "doc_id").alias("doc_id"), "sequence", "source")
    ours, theirs = scratch_path(spark, "digests/ours"), scratch_path(spark, "digests/theirs")
    digests.write_digested(state, theirs)
    digests.write_digested(copy.unionByName(extra), ours)
    compared, equal = digests.reconcile_digested(spark, ours, theirs)
    counts = compared.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(equal.select(F.lit("equal").alias("category"), "n")).groupBy("category").agg(
        F.sum("n").alias("n")).filter("n > 0")


@register("k6_bulk_apply", _FOLD_SQL)
def k6_bulk_apply(spark, sf_dir):
    """Four batches by sequence range, the second also late and again, with a compaction between."""
    c = changes(spark, sf_dir)
    top = F.coalesce(c.agg(F.max("sequence")).scalar(), F.lit(0))
    part = F.floor(F.col("sequence") * 4 / (top + 1))
    table = KeyedTable(spark)
    table.apply(c.filter(part == 0), "q0")
    table.apply(c.filter(part == 1), "q1")
    table.compact()
    for batch in ("q3", "q1", "q2", "q3"):
        table.apply(c.filter(part == int(batch[1])), batch)
    return typed_state(table.read())


#: Partial updates that carry only some of the nested keys of the document they meet.
NESTED_SQL = """
SELECT sequence, operation, index, doc_id, CASE
  WHEN operation = 'delete' THEN NULL
  WHEN operation = 'partial_update' AND sequence % 20 = 8
    THEN concat('{"meta":{"p', CAST(sequence % 3 AS VARCHAR), '":1.0},"note":"é"}')
  WHEN operation = 'partial_update' THEN concat('{"meta":{"uid":', CAST(sequence AS VARCHAR), '}}')
  ELSE concat('{"meta":{"uid":1,"keep":{"a":1.50}},"full":', CAST(sequence AS VARCHAR), '}') END AS source
FROM changes"""


def nested_changes(spark, sf_dir):
    seq = F.col("sequence")
    body = (F.when(F.col("operation") == "delete", F.lit(None).cast("string"))
            .when((F.col("operation") == "partial_update") & (seq % 20 == 8),
                  F.concat(F.lit('{"meta":{"p'), (seq % 3).cast("string"), F.lit('":1.0},"note":"é"}')))
            .when(F.col("operation") == "partial_update", F.concat(F.lit('{"meta":{"uid":'), seq.cast("string"), F.lit("}}")))
            .otherwise(F.concat(F.lit('{"meta":{"uid":1,"keep":{"a":1.50}},"full":'), seq.cast("string"), F.lit("}"))))
    return changes(spark, sf_dir).select("sequence", "operation", "index", "doc_id", body.alias("source"))


_NESTED = (
    ("nested", NESTED_SQL),
    ("marks", """
  SELECT index, doc_id, max(sequence) FILTER (WHERE operation <> 'partial_update') AS base,
         arg_max(operation, sequence) FILTER (WHERE operation <> 'partial_update') AS base_op, max(sequence) AS sequence
  FROM nested GROUP BY index, doc_id"""),
    ("parts", """
  SELECT n.index, n.doc_id, n.sequence, n.sequence % 20 = 8 AS noted, n.sequence % 3 AS p
  FROM nested n JOIN marks m USING (index, doc_id)
  WHERE n.operation = 'partial_update' AND n.sequence > coalesce(m.base, -1)"""),
    ("last_parts", """
  SELECT index, doc_id, bool_or(noted) AS noted, max(sequence) FILTER (WHERE NOT noted) AS uid,
         coalesce(bool_or(noted AND p = 0), FALSE) AS p0, coalesce(bool_or(noted AND p = 1), FALSE) AS p1,
         coalesce(bool_or(noted AND p = 2), FALSE) AS p2
  FROM parts GROUP BY index, doc_id"""))

_NESTED_FOLD_SQL = """
SELECT m.index, m.doc_id, m.sequence, CASE
    WHEN l.index IS NULL THEN concat('{"meta":{"uid":1,"keep":{"a":1.50}},"full":', CAST(m.base AS VARCHAR), '}')
    ELSE concat('{', CASE WHEN m.base_op IN ('index', 'update') THEN concat('"full":', CAST(m.base AS VARCHAR), ',') ELSE '' END,
      '"meta":{', array_to_string(list_filter([
        CASE WHEN m.base_op IN ('index', 'update') THEN '"keep":{"a":1.50}' END,
        CASE WHEN l.p0 THEN '"p0":1.0' END, CASE WHEN l.p1 THEN '"p1":1.0' END, CASE WHEN l.p2 THEN '"p2":1.0' END,
        CASE WHEN l.uid IS NOT NULL THEN concat('"uid":', CAST(l.uid AS VARCHAR))
             WHEN m.base_op IN ('index', 'update') THEN '"uid":1' END], lambda x: x IS NOT NULL), ','), '}',
      CASE WHEN l.noted THEN ',"note":"é"' ELSE '' END, '}') END AS source
FROM marks m LEFT JOIN last_parts l USING (index, doc_id)
WHERE l.index IS NOT NULL OR m.base_op IN ('index', 'update')"""


@register("w5_partial_fold_deep", _NESTED_FOLD_SQL, ctes=_NESTED)
def w5_partial_fold_deep(spark, sf_dir):
    """W5 on partial updates of nested keys: the body text itself."""
    return apply_changes(nested_changes(spark, sf_dir)).select("index", "doc_id", "sequence", "source")


@register("w5_live", _NESTED_FOLD_SQL, ctes=_NESTED)
def w5_live(spark, sf_dir):
    """W5 as a stream: three micro-batches in no order of sequence; the last emission of each document is its state."""
    src, out, ckpt = (scratch_path(spark, f"streams/live{n}") for n in ("src", "out", "ckpt"))
    c = nested_changes(spark, sf_dir)
    files = spark.sparkContext.defaultParallelism                        # of a micro-batch
    for rest in (1, 0, 2):
        c.filter(F.pmod(F.xxhash64("sequence"), F.lit(3)) == rest).repartition(files).write.mode("append").parquet(src)
    stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", files).parquet(src)
    feeds.run(live.live_documents(stream), foreach_batch=feeds.append_updates(out), checkpoint=ckpt, output_mode="update", name="live")
    return live.current_documents(spark.read.parquet(out))


@register("j2_late_partials", _NESTED_FOLD_SQL, ctes=_NESTED)
def j2_late_partials(spark, sf_dir):
    """J2 with batches out of order: the odd sequences first, then the even ones."""
    c = nested_changes(spark, sf_dir)
    table = KeyedTable(spark)
    table.apply(c.filter(F.col("sequence") % 2 == 1), "odd")
    table.apply(c.filter(F.col("sequence") % 2 == 0), "even")
    return table.read().select("index", "doc_id", "sequence", "source")
