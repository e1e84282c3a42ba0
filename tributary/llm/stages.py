"""The stages of ``corpus_pipeline``: each takes documents and lets one operator's decisions take effect."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.llm import bpe, mixing, ngram_join, ppm, repeats
from tributary.llm.common import bounded, held_out, shielded

#: Near copies in the stage: words of a shingle, and link at ``100 * intersection >= NEAR_THRESHOLD * union``.
NEAR_WORDS, NEAR_THRESHOLD = 5, 80


def known_language(spark, docs, sf_dir):
    """Language ID: documents without a recognisable language go; the others keep all columns.

    Where no row has a language to learn from, nothing is recognisable and all documents stay.
    """
    hidden, back = shielded(docs)
    learn = ~held_out(F.col("doc_id"), 4, 2)
    bounded(docs)
    trees = ppm.train(hidden.where(learn).select("doc_id", "lang", "text"))
    if trees is None:
        return docs
    found = ppm.identify(hidden, learn, keep=hidden.columns, trees=trees)
    return back(found.where(F.col("lang_pred") != ppm.UNKNOWN))


def mixed(spark, docs, sf_dir):
    """Mixing: a document is repeated as often as the mix takes it (0 to 2 times)."""
    hidden, back = shielded(docs)
    own = [c for c in hidden.columns if c.startswith("_own")]
    out = mixing.mix_sources(hidden, keep=own).where("copies > 0")
    return back(out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))


def one_of_each_group(spark, docs, sf_dir):
    """N-gram Jaccard join: of each group of linked documents the one with the smallest id stays.

    Near copies share four fifths of their five-word shingles (``op3`` itself asks for 90% of three-word ones).
    Rows that repeat an id and its text are the same document; one of them stays.  Different texts under one id
    are parts of one document; they stay or go together.  Rows without an id stay.
    """
    found = ngram_join.jaccard_components(docs.select("doc_id", "text"), NEAR_WORDS, NEAR_THRESHOLD).where("doc_id = component_id")
    kept = docs.join(found.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where("doc_id is null")).select(*docs.columns)


def without_repeats(spark, docs, sf_dir):
    """Suffix dedup: repeated bytes are cut out of the texts; ``n_chars`` follows, no document goes."""
    out = repeats.remove_repeats(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out.select(*docs.columns)


def encoded_documents(spark, docs, sf_dir):
    """BPE: the ids of every text and the text they decode to; the last stage's rows are the encoded documents."""
    return bpe.encode_documents(docs, bpe.vocabulary_path())
