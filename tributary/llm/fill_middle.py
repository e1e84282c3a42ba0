"""Operator 11: fill-in-middle by one match of a counted pattern.

``regexp_count`` gives a text's length ``n`` in code points, counted in runs of
``RUN`` and then singly, so that a long text never becomes an array of its code
points.  Two cut points ``a <= b`` come from the document's own hash; the row's
pattern ``(.{a}+)(.{b-a}+)(.*+)`` with possessive counts captures prefix, middle and
suffix in one match, and a replacement per form puts them in order around the
marks.  No step moves a row: one scan, no shuffle.

The marks occur in no cut text (such texts stay plain), and no mark can arise
where parts meet, so ``restored`` finds the parts again by the marks alone.

Defined cases: a null text is empty; empty texts stay plain; a null ``doc_id`` is
cut by the hash of the seed alone; repeated rows and rows that share an id are
cut each for itself, equal rows alike; an empty table gives an empty result; new
columns replace columns of the same name, all others stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import shielded

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Code points that are counted as one match.
RUN = 4096
NEW = ("n", "form", "prefix_chars", "middle_chars", "output")


def code_points(text: Column) -> Column:
    """How many code points a text has, by counting matches."""
    rest = F.regexp_replace(text, rf"(?s)\A(?:.{{{RUN}}}+)++", "")
    return (F.regexp_count(text, F.lit(rf"(?s).{{{RUN}}}+")) * F.lit(RUN) + F.regexp_count(rest, F.lit("(?s)."))).cast("long")


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1, cut_share: int = 90, spm_share: int = 20) -> DataFrame:
    """``docs`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``, the formatted text.

    ``cut_share`` of 100 texts are cut, ``spm_share`` of 100 of those with the suffix first.
    """
    hidden, _ = shielded(docs)
    h = draws(F.col("doc_id"), seed)
    rows = hidden.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn("_n", code_points(F.col("_text")))
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("_text", F.lit(m))
    plain = (F.col("_n") == 0) | marked | (h[2] % 100 >= cut_share)
    rows = rows.withColumns({
        "_form": F.when(plain, PLAIN).when(h[3] % 100 < spm_share, SPM).otherwise(PSM),
        "_one": h[0] % (F.col("_n") + 1), "_two": h[1] % (F.col("_n") + 1)})
    rows = rows.withColumns({"_a": F.least("_one", "_two"), "_b": F.greatest("_one", "_two")})
    pattern = F.concat(F.lit(r"(?s)\A(.{"), F.col("_a").cast("string"), F.lit("}+)(.{"),
                       (F.col("_b") - F.col("_a")).cast("string"), F.lit(r"}+)(.*+)\z"))
    order = F.when(F.col("_form") == PSM, f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    cut = F.col("_form") != PLAIN
    made = {"n": F.col("_n"), "form": F.col("_form"), "prefix_chars": F.when(cut, F.col("_a")),
            "middle_chars": F.when(cut, F.col("_b") - F.col("_a")),
            "output": F.when(cut, F.regexp_replace("_text", pattern, order)).otherwise(F.col("_text"))}
    return rows.select(*[F.col(f"_own{i}").alias(c) for i, c in enumerate(docs.columns) if c not in NEW],
                       *[v.alias(k) for k, v in made.items()])


def restored(output: Column, form: Column) -> Column:
    """The text that was cut, from the formatted text and its form."""
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z", "$2$3$1")
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def digests(docs: DataFrame, seed: int = 1) -> DataFrame:
    """Per document, digests of the formatted text and of the text rebuilt from it."""
    out = fill_in_middle(docs.select("doc_id", "text"), seed)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                      sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
