"""Operator 7: reply trees to training conversations.

``reply_paths`` takes nodes ``(tree, node, parent, role, text, score)`` and finds
the root-to-leaf paths by iterative self-joins: round ``j`` joins every node's
pointer with its target's own pointer, so it then spans ``2**(j+1)`` replies
while depth and summed score grow along; a tree of depth ``d`` takes
``log2(d)`` rounds.  Leaves rank by (summed score descending, node id), the
best ``branches`` of each tree are chosen, and the same pointer tables, in
order, mark every ancestor of a chosen leaf.  Nodes of a cycle have no root and
no path.

``format_paths`` writes each path as one conversation::

    <|im_start|>role\\nescaped text<|im_end|>\\n

In roles and texts ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|`` (in roles also a
line feed ``\\n``), so control strings inside a text never read as marks, and
``parse`` gets roles and texts back exactly.  The loss mask is a list of
``(start, end)`` code point spans of the assistant texts.

Defined cases: a null text or role is empty; a null tree id is one tree of its
own; a parent that isn't there leaves its replies without a path; repeated rows are nodes of their own (turn order, then role and text); an
empty table gives no conversation; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import staged

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and its loss spans."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role).replace(chr(10), chr(92) + 'n')}\n", escape(text)
        at += len(head)
        if role == LEARNED_ROLE:
            spans.append((at, at + len(body)))
        parts += [head, body, END, "\n"]
        at += len(body) + len(END) + 1
    return "".join(parts), spans


_TURN = re.compile(rf"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def reply_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """Rows ``(tree, leaf, depth, role, text)`` of the best ``branches`` paths of each tree.

    ``node`` and ``parent`` are longs unique within the tree; a root's parent is null.
    """
    key = F.struct("tree", "node")
    base = staged(nodes.select(key.alias("id"), F.when(F.col("parent").isNotNull(),
                  F.struct("tree", F.col("parent").alias("node"))).alias("up"),
                  F.coalesce(F.col("score"), F.lit(0.0)).alias("score"), "role", "text"), "reply-nodes")
    # an arc: the ancestor 2**j replies up, the replies and score up to it; a node whose arc
    # would pass the root is done, with its whole depth and score, and takes no further round
    first = base.select("id", "up", F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long").alias("depth"), "score")
    done = [first.where("up is null")]
    arcs = [staged(first.where("up is not null"), "reply-arcs")]
    rows = base.count()
    while 2 ** (len(arcs) - 1) <= rows and arcs[-1].limit(1).count():
        known = reduce(DataFrame.unionByName, [*done, arcs[-1]]).select(
            F.col("id").alias("bid"), F.col("up").alias("bup"), F.col("depth").alias("bdepth"),
            F.col("score").alias("bscore"))
        longer = staged(arcs[-1].join(known, F.col("up") == F.col("bid")).select(
            "id", F.col("bup").alias("up"), (F.col("depth") + F.col("bdepth")).alias("depth"),
            (F.col("score") + F.col("bscore")).alias("score")), "reply-arcs")
        done.append(longer.where("up is null"))
        arcs.append(longer.where("up is not null"))
    whole = reduce(DataFrame.unionByName, done).select("id", "depth", "score")
    leaves = whole.join(base.select(F.col("up").alias("id")), "id", "left_anti")
    rank = Window.partitionBy(F.struct(F.col("id.tree"))).orderBy(F.col("score").desc(), F.col("id.node"))
    best = (leaves.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= branches)
            .select("id", F.col("id.node").alias("leaf")))
    marks = [staged(best, "reply-marks")]
    for arc in arcs[:-1]:                 # after round j all ancestors less than 2**(j+1) replies up are marked
        marked = reduce(DataFrame.unionByName, marks)
        marks.append(staged(marked.join(arc.select("id", "up"), "id").select(F.col("up").alias("id"), "leaf"), "reply-marks"))
    marked = reduce(DataFrame.unionByName, marks)
    return (marked.join(whole.select("id", "depth"), "id").join(base.select("id", "role", "text"), "id")
            .select(F.col("id.tree").alias("tree"), "leaf", "depth", "role", "text"))


def format_paths(paths: DataFrame) -> DataFrame:
    """One row per path: ``(tree, leaf, formatted, spans)``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [format_turns([(t["role"] or "", t["text"] or "") for t in turns]) for turns in b["turns"]]
            yield pd.DataFrame({"tree": b["tree"].astype("Int64"), "leaf": b["leaf"], "formatted": [m[0] for m in made],
                                "spans": [[{"start": s, "end": e} for s, e in m[1]] for m in made]})

    grouped = (paths.groupBy(F.struct("tree", "leaf").alias("k"))
               .agg(F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
               .select("k.*", "turns"))
    return grouped.mapInPandas(run, "tree long, leaf long, formatted string, "
                                    "spans array<struct<start: int, end: int>>")


def linear_nodes(conversations: DataFrame) -> DataFrame:
    """Conversations as reply trees: each row answers the one before it."""
    tree = F.struct("conv_id")
    order = Window.partitionBy(tree).orderBy("turn", "role", "text")
    return (conversations.withColumn("node", F.row_number().over(order).cast("long"))
            .select(F.col("conv_id").alias("tree"), "node",
                    F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                    "role", "text", F.lit(1.0).alias("score")))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def read_back(formatted: DataFrame) -> DataFrame:
    """The digests of each conversation, from the formatted text and its loss spans alone."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for tree, text, spans in zip(b["tree"], b["formatted"], b["spans"], strict=True):
                turns = parse(text)
                learned = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                rows.append((tree, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)),
                             len(learned), sha(learned), len(text)))
            out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars",
                                              "loss_sha256", "formatted_chars"])
            yield out.astype({"conv_id": "Int64"})

    return formatted.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")
