"""Search-store responses as a source: explode hits and normalise them.

A response is one JSON text (``{"hits": {"hits": [...]}}``); each hit
becomes one envelope row.  Responses are bounded by the fetch size, so the
per-response work is bounded; everything else is a narrow projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.envelope import col

HITS_SCHEMA = "hits struct<hits: array<string>>"
HIT_SCHEMA = ("_index string, _id string, _seq_no decimal(20,0), _primary_term decimal(20,0), "
              "_source string")
UNKNOWN = "unknown"
DEFAULT_PRIMARY_TERM = 1


def explode_hits(responses: DataFrame, body: str = "body", keep: tuple = ()) -> DataFrame:
    """``hits.hits`` array -> one row per hit (``hit`` text, ``hit_no`` position).

    A response without the array is an error row (``hit`` NULL, ``reason`` set)
    instead of failing the job.
    """
    parsed = responses.select(*keep, F.from_json(col(body), HITS_SCHEMA).alias("_r"))
    arr = F.col("_r.hits.hits")
    ok = parsed.filter(arr.isNotNull()).select(
        *keep, F.posexplode(arr).alias("hit_no", "hit"), F.lit(None).cast("string").alias("reason"))
    bad = parsed.filter(arr.isNull()).select(
        *keep, F.lit(None).cast("int").alias("hit_no"), F.lit(None).cast("string").alias("hit"),
        F.lit("no_hits").alias("reason"))
    return ok.unionByName(bad)


def decode_hits(hits: DataFrame, hit: str = "hit", keep: tuple = ()) -> DataFrame:
    """Hit -> envelope columns and a ``reason``, set where the hit can't be taken.

    Missing ``_index`` / ``_id`` become ``unknown``; a hit without ``_seq_no`` is
    dropped; ``_primary_term`` defaults to 1; the operation is always ``index``
    and the version is the sequence.  A sequence or term above 2^63 - 1 gives a
    ``bad_sequence`` row with the hit's text, as ``codec.decode`` does.
    """
    h = F.from_json(col(hit), HIT_SCHEMA)
    p = hits.select(*keep, h.alias("_h"), col(hit).alias("_hit")).filter(F.col("_h._seq_no").isNotNull())
    seq, term = F.col("_h._seq_no").try_cast("bigint"), F.col("_h._primary_term").try_cast("bigint")
    bad = seq.isNull() | (F.col("_h._primary_term").isNotNull() & term.isNull())
    return p.select(
        *keep,
        seq.alias("sequence"),
        F.lit("index").alias("operation"),
        F.coalesce(F.col("_h._index"), F.lit(UNKNOWN)).alias("index"),
        F.coalesce(F.col("_h._id"), F.lit(UNKNOWN)).alias("doc_id"),
        F.coalesce(term, F.lit(DEFAULT_PRIMARY_TERM)).alias("primary_term"),
        seq.alias("version"),
        F.col("_h._source").alias("source"),
        F.when(bad, F.lit("bad_sequence")).alias("reason"),
        F.when(bad, F.col("_hit")).alias("payload"))


def normalise_hits(hits: DataFrame, hit: str = "hit", keep: tuple = ()) -> DataFrame:
    """The hits that can be taken, as envelope columns (``decode_hits`` has the others)."""
    return decode_hits(hits, hit, keep).filter(F.col("reason").isNull()).drop("reason", "payload")


def hit_json(seq="sequence", index="index", doc_id="doc_id", primary_term="primary_term",
             source="source"):
    """A hit as the store returns it (fields omitted when NULL)."""
    s = F.struct(col(index).alias("_index"), col(doc_id).alias("_id"),
                 col(seq).alias("_seq_no"), col(primary_term).alias("_primary_term"))
    head = F.to_json(s)
    return F.concat(head.substr(F.lit(1), F.length(head) - 1),
                    F.when(F.length(head) > 2, F.lit(",")).otherwise(F.lit("")),
                    F.lit('"_source":'), F.coalesce(col(source), F.lit("{}")), F.lit("}"))
