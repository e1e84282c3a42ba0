"""Many subject subscriptions at once (S8, F6): patterns as a trie in a table.

Patterns follow ``filters.subject_regex``: ``*`` is one token, the first ``>`` one or
more last ones.  A trie node is the pattern prefix that leads to it; an edge is
``(node, token, child)``.  Subjects walk the trie together, one equality join per
token level: at each node a subject follows the edge of its own token and the
``*`` edge.  A subject costs the nodes it reaches, not the number of patterns; no
pattern becomes an expression, and equal subjects walk once.

The trie is kept by depth, its ``*`` edges apart.  Near the root and among the ``*`` edges
it is small however many patterns there are, so those steps are broadcast joins; subjects
are only shuffled where their own tokens meet many edges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.session import materialize, release, scratch_path
from tributary.sources import storage

ONE, TAIL, SEP = "*", ">", "."


def pattern_trie(patterns: DataFrame, pattern: str = "pattern") -> tuple[DataFrame, DataFrame]:
    """Edges ``(node, token, child, depth)`` and ends ``(end, tail, pattern, depth)`` of the patterns.

    ``depth`` is the node's or the end's.  ``tail`` ends are reached with one or more tokens left, others with none.
    """
    p = patterns.select(F.col(pattern).alias("pattern")).filter("pattern IS NOT NULL").distinct()
    tokens = F.split("pattern", r"\.", -1)
    p = p.withColumn("_t", tokens).withColumn("_at", F.array_position("_t", TAIL).cast("int"))
    tail = F.col("_at") > 0
    p = p.withColumns({"tail": tail, "_t": F.when(tail, F.slice("_t", 1, F.greatest(F.col("_at") - 1, F.lit(0)))).otherwise(F.col("_t"))})
    path = lambda n: F.concat(F.lit("/"), F.array_join(F.slice("_t", 1, n), SEP), F.when(n > 0, SEP).otherwise(""))
    edges = p.select("_t", F.posexplode("_t").alias("_i", "token"))
    edges = edges.select(path(F.col("_i")).alias("node"), "token", path(F.col("_i") + 1).alias("child"),
                         F.col("_i").alias("depth")).distinct()
    return edges, p.select(path(F.size("_t")).alias("end"), "tail", "pattern", F.size("_t").alias("depth"))


def _split(df: DataFrame, by: str, kind: str) -> tuple[str, dict]:
    """A copy of ``df`` in a folder per value of ``by``: joins see how large each part is."""
    path = scratch_path(df.sparkSession, kind)
    df.write.partitionBy(by).parquet(path)
    r = df.sparkSession.read.schema(df.drop(by).schema)
    return path, {n.split("=")[1]: r.parquet(f"{path}/{n}") for n in storage.names(df.sparkSession, path)}


def match_subjects(subjects: DataFrame, patterns: DataFrame, subject: str = "subject") -> DataFrame:
    """``(subject, pattern)`` for every distinct subject and pattern that match."""
    spark = subjects.sparkSession
    edges, ends = pattern_trie(patterns)
    part = F.concat(F.when(F.col("token") == ONE, "any").otherwise("own"), F.lit("-"), F.col("depth"))
    edge_path, edges = _split(edges.withColumn("part", part).drop("depth"), "part", "stage/trie")
    end_path, ends = _split(ends, "depth", "stage/trie")
    at = subjects.select(F.col(subject).alias("subject"), F.lit("/").alias("_node")).filter("subject IS NOT NULL").distinct()
    levels, found = [materialize(at, "stage/trie-level")], []
    while True:
        depth, here = len(levels) - 1, levels[-1]
        tokens = F.split("subject", r"\.", -1)
        left = F.size(tokens) > depth
        if str(depth) in ends:
            found.append(here.join(ends[str(depth)], (F.col("_node") == F.col("end")) & (F.col("tail") == left)).select("subject", "pattern"))
        steps = []
        if f"own-{depth}" in edges:
            steps.append((edges[f"own-{depth}"], F.get(tokens, F.lit(depth))))
        if f"any-{depth}" in edges:
            steps.append((edges[f"any-{depth}"], F.lit(ONE)))
        if not steps:                            # no deeper than the longest pattern
            break
        here = here.filter(left)
        nxt = reduce(DataFrame.unionByName, [
            here.withColumn("_token", token).join(e, (F.col("_node") == F.col("node")) & (F.col("_token") == F.col("token"))).select(
                "subject", F.col("child").alias("_node")) for e, token in steps])
        levels.append(materialize(nxt, "stage/trie-level"))
        if not levels[-1].limit(1).count():      # no subject goes on
            break
    out = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "subject string, pattern string")
    out = materialize(out, "stage/trie-matches")
    release(*levels)
    for path in (edge_path, end_path):
        storage.delete(spark, path)
    return out


def subscribe(rows: DataFrame, patterns: DataFrame, subject: Column) -> DataFrame:
    """``rows`` once per pattern that matches their subject, with ``subject`` and ``pattern``."""
    with_subject = rows.withColumn("subject", subject)
    return with_subject.join(match_subjects(with_subject, patterns), "subject")
