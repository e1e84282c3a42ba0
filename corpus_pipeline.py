"""The training-data pipeline: five operators, one after the other, over ``documents``.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)``
and returns the columns of ``documents`` (the last: the encoded documents).
``run`` writes every stage's rows in the shared folder and reads them back as the
next one's input; what a stage wrote on the way, and the rows of the stage before,
go once its own are written.
"""

from __future__ import annotations

import os
import sys


sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tributary.llm import stages  # noqa: E402
from tributary.llm.common import drop_copies_since, drop_staged, live_copies, staged, table  # noqa: E402
from tributary.session import ship_package  # noqa: E402

STAGES = [
    ("language_id", stages.known_language),
    ("ngram_jaccard_join", stages.one_of_each_group),
    ("suffix_array_dedup", stages.without_repeats),
    ("mix_sources", stages.mixed),
    ("bpe_encode", stages.encoded_documents),
]

#: Context trees, similarity joins over hashes and BPE merges are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, given = live_copies(), docs
        docs = staged(stage(spark, given, sf_dir), f"pipeline-{name}")
        drop_copies_since(before, docs)
        drop_staged(given)
    return docs
