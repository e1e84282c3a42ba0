"""Latest state of every document, live (W4, W5): each micro-batch emits the documents it changed.

State per document: its last full write with the assignments of partial updates after
it (one per leaf path, so a document costs its paths, not its changes) and, after a
delete, a tombstone that lapses after ``keep_deletes_ms``.  Changes may come in
any order: sequences decide, as in ``apply.apply_changes``, and a change at or behind the
last full write is stale.  A document's last emission is its state in the fold of
all changes; once a tombstone has lapsed, older changes would count again, so it
should be kept as long as changes may be late (``None``: for good).  Lapsing goes by the
clock, so Spark then runs micro-batches without data too: such a stream takes a
processing-time trigger and is never done, as ``availableNow`` would wait for.

A group that Spark hands to Python costs far more than a document, so documents come
in ``BUCKETS`` groups by a hash of their key, as entries of the group's state.  A micro-batch
reads and writes the entries of the documents that it has changes of, and no others.
"""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tributary.operators.apply import KEY, MIN_SEQ
from tributary.operators.deep_merge import document_of, leaves_of
from tributary.session import stateful

_PARTIAL, _DELETE = "partial_update", "delete"
#: Groups of documents; the checkpoint of a stream is bound to their number.
BUCKETS = 1024
_DOC = "index string, doc_id string"
_WHOLE = ("seq bigint, body string, "
          "leaves array<struct<path: string, seq: bigint, value: string, is_obj: boolean, leaf_seq: bigint>>")


class LiveDocuments(StatefulProcessor):
    """The state of the documents of a bucket.

    ``whole`` has a document's last full write (``seq`` is null if there is none or it is a
    delete) and the leaves assigned after it, ``gone`` the sequence of a delete.
    """

    def __init__(self, keep_deletes_ms: int | None):
        self.keep_deletes_ms = keep_deletes_ms

    def init(self, handle) -> None:
        self.whole = handle.getMapState("whole", _DOC, _WHOLE)
        self.gone = handle.getMapState("gone", _DOC, "seq bigint", self.keep_deletes_ms)

    def handleInputRows(self, key, rows, timerValues):
        by_doc = defaultdict(list)
        for r in rows:
            if r["sequence"] is not None:
                by_doc[r["index"], r["doc_id"]].append(r)
        for doc, changes in by_doc.items():
            emitted = self._document(doc, changes)
            if emitted is not None:
                yield emitted

    def close(self) -> None:
        pass

    def _document(self, doc: tuple, rows: list) -> Row | None:
        """Take in a document's changes; its new state, if it has one."""
        was = self.whole.getValue(doc)
        seq, body, leaves = was if was is not None else (None, None, [])
        held = {x[0]: tuple(x[1:]) for x in leaves}
        tomb = self.gone.getValue(doc) if seq is None else None
        deleted = tomb is not None
        base = tomb[0] if deleted else MIN_SEQ if seq is None else seq
        full = max((r for r in rows if r["operation"] != _PARTIAL and r["sequence"] > base), key=lambda r: r["sequence"], default=None)
        changed = full is not None
        if changed:
            base, deleted = full["sequence"], full["operation"] == _DELETE
            body = None if deleted else full["source"]
            seq = None if deleted else base
            left = {p: x if x[3] is None or x[3] > base else (*x[:3], None) for p, x in held.items() if x[0] > base}
        else:
            left = dict(held)
        for r in rows:
            if r["operation"] == _PARTIAL and r["sequence"] > base:
                changed |= self._assign(left, r["sequence"], r["source"])
        if not changed:
            return None
        if full is not None and deleted:
            self.gone.updateValue(doc, (base,))
        elif tomb is not None and not deleted:
            self.gone.removeKey(doc)
        if seq is not None or left:
            self.whole.updateValue(doc, (seq, body, [(p, *x) for p, x in left.items()]))
        elif was is not None:
            self.whole.removeKey(doc)
        alive = bool(left) or not deleted
        return Row(**dict(zip(KEY, doc)), sequence=max([base, *[x[0] for x in left.values()]]), deleted=not alive,
                   source=self._text(base, body, left) if alive else None)

    @staticmethod
    def _assign(leaves: dict, seq: int, body) -> bool:
        """Put a partial update's leaves in; False if the same change was there already."""
        new = False
        for x in leaves_of(body):
            path = json.dumps(x["parts"])
            at, value, is_obj, leaf_seq = leaves.get(path, (MIN_SEQ, None, True, None))
            own = None if x["is_obj"] else seq
            then = max((s for s in (leaf_seq, own) if s is not None), default=None)
            now = (seq, x["value"], x["is_obj"], then) if seq > at else (at, value, is_obj, then)
            new |= leaves.get(path) != now
            leaves[path] = now
        return new

    @staticmethod
    def _text(base: int, body, leaves: dict) -> str | None:
        if not leaves:
            return body                          # no later partial update: as it was written
        merged = {json.dumps(x["parts"]): (base, x["value"], x["is_obj"], None if x["is_obj"] else base)
                  for x in (leaves_of(body) if body is not None else ())}
        for path, x in leaves.items():
            old = merged.get(path)
            merged[path] = x if old is None or x[3] is not None else (*x[:3], old[3])
        return document_of([{"parts": json.loads(p), "value": x[1], "is_obj": x[2], "seq": x[0], "leaf_seq": x[3]}
                            for p, x in merged.items()])


def live_documents(stream: DataFrame, keep_deletes_ms: int | None = None) -> DataFrame:
    """Update-mode stream of ``index, doc_id, sequence, deleted, source``: the documents a micro-batch changed."""
    stateful(stream.sparkSession)
    bucket = F.pmod(F.xxhash64(*KEY), F.lit(BUCKETS)).cast("int").alias("bucket")
    rows = stream.select(bucket, *KEY, "sequence", "operation", "source")
    return rows.groupBy("bucket").transformWithState(
        LiveDocuments(keep_deletes_ms), "index string, doc_id string, sequence bigint, deleted boolean, source string",
        "update", "None" if keep_deletes_ms is None else "ProcessingTime")


def current_documents(emitted: DataFrame) -> DataFrame:
    """The documents there are now: each one's emission of the latest micro-batch, unless it is deleted."""
    last = F.max_by(F.struct("sequence", "deleted", "source"), "batch_id").alias("_d")
    return emitted.groupBy(*KEY).agg(last).filter("NOT _d.deleted").select(*KEY, "_d.sequence", "_d.source")
