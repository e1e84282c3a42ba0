"""Operator 12: lines that repeat across documents, dropped but for one document.

Every text is split in lines; a line's key is the line without white space at
both ends and with A-Z in lower case.  Keys of at least ``min_chars`` code points
are hashed to 128 bits, documents are counted per hash (first per hash and
document, then per hash, so a line that a third of all documents hold is counted
in parallel), and the positions of lines to drop come back to their text, which
is put together again by position.  Only hashes and positions meet by key; texts
move once, with their list of positions.

Hashes that hold at least 1 / ``common.HOT`` of the repeated lines are joined by
broadcast, and there can't be more than ``HOT`` of them; the others meet in a
shuffle in which none of them is large.

Defined cases: a null or empty text is one empty line (a null text stays null);
rows that share a ``doc_id`` are one document, each keeping or dropping its own
lines; rows without a ``doc_id`` belong to no document: they keep all lines and
count for no key; an empty table gives an empty result; ``text``, ``n_lines`` and
``n_dropped`` replace columns of the same name, all others stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import drop_staged, join_counted, shielded, staged

#: Drop keys of at least ``MIN_CHARS`` code points that at least ``MIN_DOCS`` documents hold.
MIN_DOCS, MIN_CHARS = 2, 10
_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z (and no other letters) in lower case."""
    bare = F.btrim(line, F.lit(_WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def repeated_lines(keys: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Hashes that at least ``min_docs`` documents hold, with the smallest document and the number of lines."""
    per_doc = keys.groupBy(*_HASH, "doc_id").agg(F.count(F.lit(1)).alias("lines"))
    return (per_doc.groupBy(*_HASH).agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first"),
                                        F.sum("lines").alias("lines"))
            .where(F.col("docs") >= min_docs).drop("docs"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines out of ``text``, ``n_lines`` (before) and ``n_dropped``."""
    hidden, _ = shielded(docs)
    same_text = F.xxhash64("text")                   # tells rows of one document apart
    lines = (hidden.where("doc_id is not null")
             .select("doc_id", same_text.alias("row"), F.posexplode(_split(F.col("text"))).alias("pos", "line"))
             .where(F.char_length("line") >= min_chars)
             .select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
             .where(F.char_length("key") >= min_chars))
    keys = staged(lines.select("doc_id", "row", "pos", F.xxhash64("key").alias("h1"),
                               F.xxhash64(F.lit("line"), "key").alias("h2")), "line-keys")
    repeated = staged(repeated_lines(keys, min_docs), "line-repeats")
    gone = join_counted(keys, repeated, _HASH, "lines").where(F.col("doc_id") != F.col("first"))
    drops = staged(gone.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("gone")), "line-drops")
    drop_staged(keys, repeated)
    new = ("text", "n_lines", "n_dropped")
    own = [F.col(f"_own{i}") for i, c in enumerate(docs.columns) if c not in new]
    texts = hidden.select(*own, "doc_id", same_text.alias("row"), F.col("text").isNull().alias("_null"),
                          _split(F.col("text")).alias("_lines"))
    met = texts.join(drops, ["doc_id", "row"], "left").withColumn("_gone", F.coalesce("gone", F.array().cast("array<int>")))
    last = F.size("_lines") - 1
    stay = F.array_except(F.sequence(F.lit(0), last), F.col("_gone"))
    kept = F.when(F.size("_gone") == 0, F.array_join("_lines", "\n")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n"))
    made = {"text": F.when(~F.col("_null"), kept), "n_lines": F.size("_lines").cast("long"),
            "n_dropped": F.size("_gone").cast("long")}
    names = [c for c in docs.columns if c not in new]
    order = [c for c in docs.columns if c not in new[1:]] + list(new[1:])
    out = dict(zip(names, own)) | made
    return met.select(*[out[c].alias(c) for c in order])


def digests(docs: DataFrame) -> DataFrame:
    """Per document: lines, dropped lines and the digest of what is left."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
