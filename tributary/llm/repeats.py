"""Operator 9: remove repeated byte strings, by sampled prefix doubling.

A byte goes if a ``LENGTH``-byte string that covers it also starts anywhere
else, in its own document or another; judged on the input, overlaps included.

Plain prefix doubling sorts pairs of ranks for every position of the corpus.
Here the rank of a string is its hash (equal strings have equal hashes, so no
renumbering is needed), and the positions are thinned out without losing any:

1. *Rank of GRAM bytes at sampled positions.*  Every window of ``LENGTH`` bytes has an
   anchor, the leftmost smallest hash among its ``GRAM``-byte strings, which equal
   windows share at the same place.  Consecutive windows with one anchor form a
   block.  Spark sorts the blocks by the rank of their anchor; blocks whose rank
   is unique hold no repeated window and drop out.
2. *Rank pairs at the next offset: (anchor, whole block).*  A block whose whole
   extent (its first window to its last) occurs twice is repeated altogether.
3. *Rank pairs at single offsets.*  Blocks left undecided, and one copy of each
   decided one that may hold their partners, go in slices of ``SLICE`` windows.
   All windows of a slice share a core; Spark sorts by (anchor, place, core),
   unique ones drop out, and among the others windows compare by their bytes.

Copies within a map task are decided there, so a text that makes up a third of
the corpus is sent about once per task.  Runs of windows, never positions, travel;
but where more than ``CROWD`` undecided blocks share an anchor (a passage in
documents that differ around it), their slices are dealt in salted parts, each
part settles its own copies and sends one row per distinct window, and Spark
counts those by their hash.  No frame grows with the number of such blocks.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` lose nothing;
rows that repeat a document remove each other; ids must be unique for documents
to be told apart, rows that share an id are numbered and kept apart; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import Rolling, add_columns, bounded, encoded, mix, staged, text_slices, whole_groups

LENGTH = 200
#: Bytes of an anchor's string.
GRAM = 64
#: Text bytes hashed at a time (numbers take some hundred times as much).
BATCH = 1 << 18
#: Windows that travel together once a block is undecided.
SLICE = 34
#: Slices of one place and core that are compared in one frame; more are dealt in parts of about so many.
CROWD = 1 << 14


class Anchors:
    """Blocks of windows of a batch of texts."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram, self.span = length, gram, length - gram + 1
        self.one, self.two = Rolling(91), Rolling(92)

    def blocks(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """doc, first, last (windows by start), anchor (all within the text), rank and whole hash of each block."""
        sizes = np.array([len(t) for t in texts], np.int64)
        buf = np.frombuffer(b"".join(texts), np.uint8)
        n = len(buf) - self.length + 1
        if n <= 0:
            return self._none()
        starts = np.cumsum(sizes) - sizes
        doc_of = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        inside = doc_of[:n] == doc_of[self.length - 1:]
        if not inside.any():
            return self._none()
        prefix = self.one.prefix(buf)
        grams = self.one.fixed(prefix, self.gram)
        # the leftmost smallest of each window: position in the low bits breaks ties to the left
        bits = max(28, len(grams).bit_length())
        low = np.uint64(bits)
        key = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_sliding_min(key, self.span)[:n] & np.uint64((1 << bits) - 1)).astype(np.int64)
        change = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
                                 | (doc_of[1:n] != doc_of[:n - 1])])
        first = np.flatnonzero(change)
        last = np.concatenate([first[1:], [n]]) - 1
        keep = inside[first]
        first, last = first[keep], last[keep]
        doc, at = doc_of[first].astype(np.int64), anchor[first]
        whole = self.two.of(self.two.prefix(buf), first, last + self.length)
        return {"doc": doc, "first": first - starts[doc], "last": last - starts[doc], "anchor": at - starts[doc],
                "rank": grams[at], "whole": whole}

    @staticmethod
    def _none() -> dict[str, np.ndarray]:
        z = np.zeros(0, np.int64)
        return {"doc": z, "first": z, "last": z, "anchor": z, "rank": z.astype(np.uint64), "whole": z.astype(np.uint64)}


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, from running minima of blocks of that width."""
    n = len(x)
    rows = -(-n // width)
    grid = np.full(rows * width, np.iinfo(x.dtype).max, x.dtype)
    grid[:n] = x
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1:n])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


#: What becomes of a block: repeated as a whole, undecided, or sent along for the undecided.
WHOLE, OPEN, HELPER = 0, 1, 2
#: A row about a rank: ``key`` undecided and sent blocks have it, more than ``CROWD``.
CROWDED = 3
#: What a row of a comparison is: a run of repeated windows, a window that asks the other parts, one that only answers.
RUN, ASKS, ANSWERS = 0, 1, 2


def find_repeats(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(key, first, last)``: runs of repeated windows of ``texts`` (``key``, unique, and ``text``)."""
    spark = bounded(texts)
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def anchored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Anchors(length)
        for b in batches:
            key = b["key"].to_numpy()
            for part, data in text_slices(b, BATCH):
                own = key[part]
                x = make.blocks(data)
                if not len(x["doc"]):
                    continue
                # equal blocks of one task: decided here; the first goes on for all of them
                order = np.lexsort((x["whole"], x["rank"]))
                r, w = x["rank"][order], x["whole"][order]
                new = np.concatenate([[True], (r[1:] != r[:-1]) | (w[1:] != w[:-1])])
                size = np.diff(np.concatenate([np.flatnonzero(new), [len(new)]]))
                twice = np.empty(len(new), bool)
                twice[order] = np.repeat(size > 1, size)
                lead = np.empty(len(new), bool)
                lead[order] = new
                # blocks decided here that nobody waits for are dealt by a rank of their own
                rank = np.where(lead, x["rank"], x["whole"] * np.uint64(2) + x["first"].astype(np.uint64))
                yield pd.DataFrame({"rank": _signed(rank), "whole": _signed(x["whole"]), "key": own[x["doc"]],
                                    "first": x["first"].astype(np.int32),
                                    "size": (x["last"] - x["first"]).astype(np.int16),
                                    "ahead": (x["anchor"] - x["first"]).astype(np.int16),
                                    "state": np.where(lead, np.where(twice, 1, 0), 2).astype(np.int8)})

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows in order of rank and whole hash: ``state`` 2 is decided, 1 has a copy in its task, 0 is alone there.

        A rank's rows may fill many batches; of those before only counts and at most ``CROWD`` rows are kept.
        """
        columns = ["key", "first", "size", "ahead", "rank"]
        at, waits, count, waiting = 0, False, 0, []          # of the rank the last batch ended in
        for rows, lo, hi in _with_neighbours(batches):
            rank, whole, state = (rows[c].to_numpy() for c in ("rank", "whole", "state"))
            free = state < 2
            link = (rank[1:] == rank[:-1]) & free[1:] & free[:-1]
            same = link & (whole[1:] == whole[:-1])
            before, after = (np.concatenate(x)[lo:hi] for x in (([False], link), (link, [False])))
            copy_before, copy_after = (np.concatenate(x)[lo:hi] for x in (([False], same), (same, [False])))
            out, free = rows[columns].iloc[lo:hi], free[lo:hi]
            several = copy_before | copy_after | (state[lo:hi] >= 1)
            # group 0 is the rank of the rows before; a rank waits if a block of it is undecided
            group = np.cumsum(~before)
            n = int(group[-1]) + 1
            wait = np.bincount(group, ~several, n) > 0
            wait[0] |= waits
            opened = ~several & (before | after)
            helps = several & free & ~copy_before
            asks = opened | (helps & wait[group])
            counts = np.bincount(group, asks, n).astype(np.int64)
            counts[0] += count
            if wait[0] and waiting:
                counts[0] += sum(map(len, waiting))
                yield from (x.assign(state=np.int8(HELPER)) for x in waiting)
            if n > 1 or wait[0]:
                waiting = []
            yield out[several].assign(state=np.int8(WHOLE))
            yield out[opened].assign(state=np.int8(OPEN))
            yield out[helps & wait[group]].assign(state=np.int8(HELPER))
            ranks = np.full(n, at, np.int64)
            ranks[group] = rank[lo:hi]
            yield _crowded(ranks[:-1], counts[:-1])
            late = helps & ~wait[group] & (group == n - 1)
            if late.any():
                waiting.append(out[late])
            at, waits, count = ranks[-1], bool(wait[-1]), int(counts[-1])
            if sum(map(len, waiting)) > CROWD:               # sent though nobody may ask: they only answer
                count += sum(map(len, waiting))
                yield from (x.assign(state=np.int8(HELPER)) for x in waiting)
                waiting, waits = [], True
        yield _crowded(np.array([at]), np.array([count]))

    def _crowded(ranks: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        many = counts > CROWD
        return pd.DataFrame({"key": counts[many], "first": np.int32(0), "size": np.int16(0), "ahead": np.int16(0),
                             "rank": ranks[many], "state": np.int8(CROWDED)})

    kinds = "key long, first int, size short, ahead short, rank long, state byte"
    decided = staged(texts.mapInPandas(anchored, "rank long, whole long, key long, first int, size short, ahead short, state byte")
                     .repartition(spread, "rank").sortWithinPartitions("rank", "whole")
                     .mapInPandas(decide, kinds), "repeat-blocks")
    whole = decided.where(F.col("state") == WHOLE).select("key", "first", (F.col("first") + F.col("size")).alias("last"))
    # one row per CROWD blocks at most: a bounded broadcast
    crowded = decided.where(F.col("state") == CROWDED).select("rank", F.ceil(F.col("key") / CROWD).alias("parts"))
    asked = (decided.where(F.col("state").isin(OPEN, HELPER)).join(F.broadcast(crowded), "rank", "left")
             .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("key", "first"), "parts"), F.lit(-1)).cast("int"))
             .groupBy("key").agg(F.collect_list(F.struct("first", "size", "ahead", "rank", "state", "salt")).alias("blocks")))
    margin = SLICE - 1

    def sliced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Slices of the asked blocks: place from the anchor, core hash, and the bytes around the core."""
        roll = Rolling(93)
        for b in batches:
            out = []
            for key, text, blocks in zip(b["key"], encoded(b["text"]), b["blocks"], strict=True):
                buf = np.frombuffer(text, np.uint8)
                prefix = roll.prefix(buf)
                rows = []
                for x in blocks:
                    first, last, anchor = x["first"], x["first"] + x["size"], x["first"] + x["ahead"]
                    # window w is anchor - w bytes before its anchor; slices are cut by that distance
                    for s in range((anchor - last) // SLICE, (anchor - first) // SLICE + 1):
                        a, z = anchor - (s + 1) * SLICE + 1, anchor - s * SLICE
                        rows.append((max(a, first), min(z, last), a, s, x["rank"], x["state"], x["salt"]))
                r = np.array(rows, np.int64).reshape(-1, 7)
                cores = roll.of(prefix, r[:, 2] + margin, r[:, 2] + length)
                padded = b"\0" * margin + text + b"\0" * margin
                for (lo, hi, a, s, rank, state, salt), core in zip(r.tolist(), _signed(cores).tolist(), strict=True):
                    out.append((rank, s, core, salt, key, lo, hi - lo, lo - a, state,
                                padded[a + margin:a + 2 * margin], padded[a + length + margin:a + length + 2 * margin]))
            if out:
                yield pd.DataFrame(out, columns=_SLICED)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, _PART):
            yield _compare(rows)

    found = staged(asked.join(texts, "key").select("key", "text", "blocks")
                   .mapInPandas(sliced, "rank long, place int, core long, salt int, key long, first int, size int, skip int, "
                                        "state int, left binary, right binary")
                   .repartition(spread, *_PART).sortWithinPartitions(*_PART)
                   .mapInPandas(compare, "key long, first int, last int, kind byte, code long"), "repeat-windows")
    # a part sends a window once, so a code has as many rows as there are parts at most
    across = (found.where(F.col("kind") != RUN).groupBy("code")
              .agg(F.count(F.lit(1)).alias("n"),
                   F.collect_list(F.when(F.col("kind") == ASKS, F.struct("key", "first", "last"))).alias("at"))
              .where("n > 1").select(F.explode("at").alias("x")).select("x.*"))
    return whole.unionByName(found.where(F.col("kind") == RUN).select("key", "first", "last")).unionByName(across)


#: What slices that are compared in one frame have in common (``salt`` is -1 where a rank isn't crowded).
_PART = ["rank", "place", "core", "salt"]
_SLICED = [*_PART, "key", "first", "size", "skip", "state", "left", "right"]


def _with_neighbours(batches):
    """Batches that also hold the row before and the row after: (rows, first own one, end of the own ones)."""
    kept, lo = None, 0
    for b in batches:
        if not len(b):
            continue
        rows = b if kept is None else pd.concat([kept, b], ignore_index=True)
        kept = rows
        if len(rows) - 1 > lo:
            yield rows, lo, len(rows) - 1
            kept, lo = rows.iloc[-2:], 1
    if kept is not None:
        yield kept, lo, len(kept)


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """Among slices of one rank, place and core: the undecided ones' windows that equal another's at the same place.

    Of a part of a crowded rank also every distinct window, for the other parts.
    """
    rank, place, core, salt = (rows[c].to_numpy() for c in _PART)
    new = np.concatenate([[True], (rank[1:] != rank[:-1]) | (place[1:] != place[:-1]) | (core[1:] != core[:-1])
                          | (salt[1:] != salt[:-1])])
    group = np.cumsum(new) - 1
    is_open = rows["state"].to_numpy() == OPEN
    ask = (np.bincount(group) > 1) & (np.bincount(group, is_open.astype(float)) > 0) | (salt[new] >= 0)
    rows, group, is_open = rows[ask[group]], group[ask[group]], is_open[ask[group]]
    if not len(rows):
        return _windows(np.zeros(0, np.int64), 0, 0, RUN, 0)
    first, size, skip, keys = (rows[c].to_numpy(np.int64) for c in ("first", "size", "skip", "key"))
    rank, place, core, salt = (rows[c].to_numpy(np.int64) for c in _PART)
    part = mix(mix(mix(rank.view(np.uint64)) + core.view(np.uint64)) + place.view(np.uint64))
    left = np.frombuffer(b"".join(rows["left"]), np.uint8).reshape(len(rows), -1)
    right = np.frombuffer(b"".join(rows["right"]), np.uint8).reshape(len(rows), -1)
    margin = left.shape[1]
    # window j of a slice holds the core, the last margin - j bytes before it and the first j after it
    before, after = _ranks(left[:, ::-1], 94), _ranks(right, 95)
    hit, out = np.zeros((len(rows), margin + 1), bool), []
    for j in range(margin + 1):
        has = np.flatnonzero((skip <= j) & (j <= skip + size))
        if not len(has):
            continue
        code, own = before[has, margin - j] + after[has, j], group[has]
        order = np.lexsort((code, own))
        equal = (code[order][1:] == code[order][:-1]) & (own[order][1:] == own[order][:-1])
        twice = np.concatenate([[False], equal]) | np.concatenate([equal, [False]])
        hit[has[order], j] = twice
        lead = np.concatenate([[True], ~equal]) & (salt[has[order]] >= 0)
        if lead.any():
            at = has[order][lead]
            known = mix(mix(part[at] + np.uint64(j)) + code[order][lead]).view(np.int64)
            window = first[at] - skip[at] + j
            out.append(_windows(keys[at], window, window, np.where(is_open[at] & ~twice[lead], ASKS, ANSWERS), known))
    hit &= is_open[:, None]
    edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    r, a = np.nonzero(edge == 1)
    z = np.nonzero(edge == -1)[1] - 1
    return pd.concat([_windows(keys[r], first[r] - skip[r] + a, first[r] - skip[r] + z, RUN, 0), *out], ignore_index=True)


def _windows(key, first, last, kind, code) -> pd.DataFrame:
    return pd.DataFrame({"key": key, "first": np.asarray(first, np.int32), "last": np.asarray(last, np.int32),
                         "kind": np.asarray(kind, np.int8), "code": np.asarray(code, np.int64)}, index=range(len(key)))


def _ranks(x: np.ndarray, seed: int) -> np.ndarray:
    """``out[i, k]``: the rank (hash) of the first ``k`` bytes of row ``i``."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 2**64, (x.shape[1], 256), dtype=np.uint64)
    out = np.zeros((len(x), x.shape[1] + 1), np.uint64)
    np.cumsum(values[np.arange(x.shape[1])[None, :], x], axis=1, out=out[:, 1:])
    return out


def cover(text: bytes, spans, length: int = LENGTH) -> tuple[bytes, int, int]:
    """What is left of a text, bytes removed and removed runs, from runs of repeated windows."""
    if spans is None or not len(spans):
        return text, 0, 0
    edge = np.zeros(len(text) + 1, np.int64)
    s = np.asarray(spans, np.int64)                      # first window << 32 | last window
    np.add.at(edge, s >> 32, 1)
    np.add.at(edge, (s & 0xFFFFFFFF) + length, -1)
    gone = np.cumsum(edge)[:-1] > 0
    n = int(gone.sum())
    return (np.frombuffer(text, np.uint8)[~gone].tobytes(), n,
            int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0]))


def _with_spans(docs: DataFrame, length: int) -> DataFrame:
    """``docs`` with ``_key`` and the list ``_spans`` of its repeated windows."""
    spans = find_repeats(docs.select(F.col("_key").alias("key"), "text"), length)
    packed = F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR(F.col("last").cast("long"))
    lists = spans.groupBy(F.col("key").alias("_key")).agg(F.collect_list(packed).alias("_spans"))
    return docs.join(lists, "_key", "left")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a unique number ``_key`` per row.

    ``doc_id`` where it is unique and not null; else rows are numbered once and written, so the
    numbers hold when a lost task runs again.
    """
    n, ids, known = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id"), F.count("doc_id")).first()
    if n == ids == known:
        return docs.withColumn("_key", F.col("doc_id").cast("long"))
    return staged(docs.withColumn("_key", F.monotonically_increasing_id()), "repeat-keyed")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with ``text`` cut to the bytes that stay, in all its columns; a cut character's rest is left out."""
    def make():
        def cut(texts, spans):
            return {"text": [t if not s else cover(x, s, length)[0].decode("utf-8", "ignore")
                             for t, x, s in zip(texts, encoded(texts), spans, strict=True)]}
        return cut

    out = add_columns(_with_spans(keyed(docs), length), "text", "text string", make, docs.columns, ["_spans"])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def repeat_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every document."""
    def make():
        def digest(texts, spans):
            data = encoded(texts)
            left = [cover(t, s, length) for t, s in zip(data, spans, strict=True)]
            return {"n_bytes": [len(t) for t in data], "n_removed": [x[1] for x in left],
                    "n_spans": [x[2] for x in left], "kept_sha256": [hashlib.sha256(x[0]).hexdigest() for x in left]}
        return digest

    return add_columns(_with_spans(keyed(docs.select("doc_id", "text")), length), "text",
                       "n_bytes long, n_removed long, n_spans long, kept_sha256 string", make, ["doc_id"], ["_spans"])
