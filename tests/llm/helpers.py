"""Small tables and plain rules that the operator tests share."""

import duckdb

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASHES = ("size", "target", "copies", "taken", "score", "lang_pred", "key", "spans", "component", "id", "n", "_id", "rank")


def docs_frame(spark, rows, extra=False):
    """Documents from ``(doc_id, text, lang, source)``, with clashing extra columns if asked."""
    df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], DOCS)
    if extra:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
    return df


def odd_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    long = "a very long text with many words and letters in it, " * 3000
    return [(1, "the same words again and again and again", "en", "a"), (1, "the same words again and again and again", "en", "a"),
            (2, "the same words again and again and again", "en", None), (3, None, "en", "a"), (4, "", "de", "a"),
            (5, long, None, "b"), (6, long, "en", "b"), (7, "12 34 !!", "de", None), (None, "no id here at all", "de", "c"),
            (8, "der die das und ein haus", "de", "c"), (9, " \t\n", None, None), (10, "élan  vital\x0bété", "fr", "c")]


def duck(sql, **frames):
    """DuckDB rows of ``sql`` over pandas frames, as dicts sorted by all values."""
    con = duckdb.connect()
    for name, pdf in frames.items():
        con.register(name, pdf)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return [dict(zip(names, r)) for r in cur.fetchall()]
