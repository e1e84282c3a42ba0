"""Keyed apply of a change feed onto a document table.

State model: one row per key ``(index, doc_id)`` with ``sequence`` (last
applied change), ``deleted`` (tombstone) and ``source`` (JSON body).

Semantics, decided by sequence (never by arrival order):

* ``index`` / ``update`` replace the whole document, ``delete`` removes it;
* ``partial_update`` merges its objects recursively into the document current
  at that point (or into an empty one: upsert);
* a change at or below the sequence of a folded document is stale and ignored.

``KeyedTable`` appends batches as they are and folds them when read, so late
and repeated changes give the same state as one run in order until a
compaction folds them for good.
"""

from __future__ import annotations

import json
import uuid
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.deep_merge import build_document, flatten_leaves
from tributary.session import scratch_path, ship_package
from tributary.sources import storage

KEY = ("index", "doc_id")
STATE_COLUMNS = ("sequence", "deleted", "source")
MIN_SEQ = -(2 ** 63)


def latest_per_key(changes: DataFrame, key: Sequence[str] = KEY, seq: str = "sequence",
                   keep_deletes: bool = False) -> DataFrame:
    """The last change per key decides its state; deletes remove the key."""
    last = F.max_by(F.struct(F.col(seq).alias("sequence"), F.col("operation").alias("operation"),
                             F.col("source").alias("source")), F.col(seq))
    g = changes.groupBy(*key).agg(last.alias("_last"))
    if not keep_deletes:
        g = g.filter(F.col("_last.operation") != "delete")
    return g.select(*key, "_last.sequence", "_last.operation", "_last.source")


def apply_changes(changes: DataFrame, target: DataFrame | None = None, key: Sequence[str] = KEY,
                  seq: str = "sequence", keep_tombstones: bool = False) -> DataFrame:
    """Fold ``changes`` onto ``target`` (both keyed by ``key``).

    ``target`` has ``key + (sequence, deleted, source)``; ``None`` = empty.
    Returns the new state of every key in either input (tombstones kept only
    with ``keep_tombstones``).

    First only sequences are aggregated: per key the last full write and the
    last partial update.  Joining them back leaves the changes that matter,
    the base document and the partial updates after it; a body without later
    partial updates passes as it is, the others meet leaf by leaf.
    """
    ship_package(changes.sparkSession)
    key = list(key)
    c = changes.select(*key, F.col(seq).alias("_seq"), F.col("operation").alias("_op"), F.col("source").alias("_src"))
    partial = F.col("_op") == "partial_update"
    marks = c.groupBy(*key).agg(F.max(F.when(~partial, F.col("_seq"))).alias("_full"),
                                F.max(F.when(partial, F.col("_seq"))).alias("_part"))
    if target is not None:
        held = target.select(*key, F.col("sequence").alias("_held"), F.col("deleted").alias("_gone"),
                             F.col("source").alias("_body"))
        marks = marks.join(held.select(*key, "_held"), key, "full_outer")
    else:
        held, marks = None, marks.withColumn("_held", F.lit(None).cast("bigint"))
    fresh = F.col("_full").isNotNull() & (F.col("_held").isNull() | (F.col("_full") > F.col("_held")))
    base = F.when(fresh, F.col("_full")).otherwise(F.col("_held"))
    marks = marks.select(*key, base.alias("_base"), fresh.alias("_fresh"),
                         F.coalesce(F.col("_part") > F.coalesce(base, F.lit(MIN_SEQ)), F.lit(False)).alias("_merges"))
    live = c.join(marks, key).filter(
        F.when(partial, F.col("_seq") > F.coalesce(F.col("_base"), F.lit(MIN_SEQ)))
        .otherwise(F.col("_fresh") & (F.col("_seq") == F.col("_base"))))
    rows = live.select(*key, "_seq", "_merges", (F.col("_op") == "delete").alias("_gone"), F.col("_src").alias("_body"))
    if held is not None:
        kept = held.join(marks, key).filter(~F.col("_fresh"))
        rows = rows.unionByName(kept.select(*key, F.col("_held").alias("_seq"), "_merges", "_gone", "_body"))

    none = F.lit(None)
    whole = F.array(F.struct(none.cast("array<string>").alias("parts"), F.col("_body").alias("value"),
                             F.lit(False).alias("is_obj")))
    # a deleted base only leaves the empty root to the partial updates after it
    parts = flatten_leaves(F.when(F.col("_merges") & ~F.col("_gone"), F.col("_body")))
    x = rows.select(*key, "_seq", "_gone", F.explode(F.when(F.col("_merges"), parts).otherwise(whole)).alias("e"))
    per_path = x.groupBy(*key, F.col("e.parts").alias("parts")).agg(
        F.max_by(F.struct(F.col("e.value").alias("value"), F.col("e.is_obj").alias("is_obj"), "_gone"), "_seq").alias("last"),
        F.max("_seq").alias("seq"), F.max(F.when(~F.col("e.is_obj"), F.col("_seq"))).alias("leaf_seq"))
    merged = F.col("parts").isNotNull()
    docs = per_path.groupBy(*key).agg(
        F.max("seq").alias("sequence"),
        F.max(F.when(~merged, F.struct(F.col("last._gone").alias("gone"), F.col("last.value").alias("value")))).alias("whole"),
        F.collect_list(F.when(merged, F.struct("parts", F.col("last.value").alias("value"),
                                               F.col("last.is_obj").alias("is_obj"), "seq", "leaf_seq"))).alias("leaves"))
    gone = F.coalesce(F.col("whole.gone"), F.lit(False))
    out = docs.select(*key, "sequence", gone.alias("deleted"),
                      F.when(~gone, F.coalesce(F.col("whole.value"), build_document("leaves"))).alias("source"))
    return out if keep_tombstones else out.filter(~F.col("deleted"))


def reconcile(target: DataFrame, expected: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Compare a replicated table with the state the source implies.

    Category per key: ``equal``, ``stale`` (older sequence), ``different``
    (same sequence, other body), ``missing`` (not in target), ``extra``.
    """
    key = list(key)
    t = target.select(*key, F.col("sequence").alias("t_seq"), F.col("source").alias("t_src"))
    e = expected.select(*key, F.col("sequence").alias("e_seq"), F.col("source").alias("e_src"))
    j = t.join(e, key, "full_outer")
    cat = (F.when(F.col("t_seq").isNull(), F.lit("missing"))
           .when(F.col("e_seq").isNull(), F.lit("extra"))
           .when(F.col("t_seq") != F.col("e_seq"), F.lit("stale"))
           .when(~F.col("t_src").eqNullSafe(F.col("e_src")), F.lit("different"))
           .otherwise(F.lit("equal")))
    return j.select(*key, cat.alias("category"))


class TableConflict(RuntimeError):
    """Other writers published versions faster than this one could."""


class KeyedTable:
    """K6: a document table on shared storage as a log of change batches over a compacted base.

    ``apply`` writes the batch's changes as one new folder and then publishes a
    manifest that names it: existing files are never touched, readers see the
    version before or after, and a failure in between leaves the version
    before.  ``read`` folds the listed batches onto the base.  ``compact`` folds
    batches into a new base.  Two writers that publish the same version number
    collide on the manifest's name; the later one publishes the next.

    A batch id already listed is not applied again.  After a compaction its
    changes are stale by sequence; so is a change that arrives later than a
    compaction that included newer changes of its document.
    """

    CHANGES = "index string, doc_id string, sequence bigint, operation string, source string"
    STATE = "index string, doc_id string, sequence bigint, deleted boolean, source string"

    def __init__(self, spark, path: str | None = None, key: Sequence[str] = KEY):
        self.spark, self.key = spark, list(key)
        self.path = path or scratch_path(spark, "tables")

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in storage.names(self.spark, f"{self.path}/manifests")
                if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """The named or the latest version: ``base`` folder (or None) and ``batches``, id to folder."""
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "base": None, "batches": {}}
        version = known[-1] if version is None else version
        return json.loads(storage.read_text(self.spark, f"{self.path}/manifests/{version:020d}.json"))

    def _publish(self, change, attempts: int = 20) -> dict:
        """Publish ``change(latest manifest)`` as the next version; None from it = nothing to do."""
        for _ in range(attempts):
            now = self.manifest()
            new = change(now)
            if new is None:
                return now
            new = {**new, "version": now["version"] + 1}
            if storage.publish_text(self.spark, f"{self.path}/manifests/{new['version']:020d}.json", json.dumps(new)):
                return new
        raise TableConflict(self.path)

    def apply(self, batch: DataFrame, batch_id: str | None = None) -> None:
        """Append a batch of changes; a batch id that is already in does nothing."""
        batch_id = str(batch_id if batch_id is not None else uuid.uuid4().hex)
        if batch_id in self.manifest()["batches"]:
            return
        folder = f"batch-{batch_id}-{uuid.uuid4().hex[:8]}"
        (batch.select(*[f.split()[0] for f in self.CHANGES.split(", ")])
         .write.parquet(f"{self.path}/{folder}"))
        self._publish(lambda m: None if batch_id in m["batches"] else
                      {**m, "batches": {**m["batches"], batch_id: folder}})

    def _state(self, m: dict, keep_tombstones: bool) -> DataFrame:
        base = None
        if m["base"]:
            base = self.spark.read.schema(self.STATE).parquet(f"{self.path}/{m['base']}")
        if not m["batches"]:
            out = base if base is not None else self.spark.createDataFrame([], self.STATE)
            return out if keep_tombstones else out.filter(~F.col("deleted"))
        changes = self.spark.read.schema(self.CHANGES).parquet(
            *[f"{self.path}/{folder}" for folder in m["batches"].values()])
        return apply_changes(changes, base, self.key, keep_tombstones=keep_tombstones)

    def read(self, include_tombstones: bool = False, version: int | None = None) -> DataFrame:
        return self._state(self.manifest(version), include_tombstones)

    def compact(self) -> None:
        """Fold the listed batches into a new base; batches published meanwhile stay listed."""
        m = self.manifest()
        if not m["batches"]:
            return
        folder = f"base-{uuid.uuid4().hex}"
        self._state(m, keep_tombstones=True).write.parquet(f"{self.path}/{folder}")
        folded = set(m["batches"])

        def swap(now: dict) -> dict | None:
            if now["base"] != m["base"]:          # another compaction was first
                return None
            return {"base": folder, "batches": {k: v for k, v in now["batches"].items() if k not in folded}}
        self._publish(swap)

    def vacuum(self, keep: int = 2) -> None:
        """Delete folders and manifests that none of the last ``keep`` versions names.

        Run it when no batch is being written: a folder counts only once its manifest is out.
        """
        known = self.versions()
        used = {"manifests"}
        for v in known[-keep:]:
            m = self.manifest(v)
            used |= {m["base"], *m["batches"].values()}
        for v in known[:-keep]:
            storage.delete(self.spark, f"{self.path}/manifests/{v:020d}.json")
        for name in storage.names(self.spark, self.path):
            if name not in used:
                storage.delete(self.spark, f"{self.path}/{name}")
