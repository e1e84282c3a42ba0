"""The operators over their whole tables, as registered queries, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import bpe, chat, codes, fill_middle, lines, mixing, ngram_join, ppm, quality, repeats, toxicity, vectors
from tributary.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


#: The same rule as ``mixing``: one window over each whole source instead of bins.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, avg(size) AS mean_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight
  FROM d GROUP BY source),
c AS (SELECT *, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM c),
f AS (SELECT arg_min(level, cap / weight) AS level FROM l WHERE level * weight < cap),
t AS (
  SELECT c.*, CASE WHEN f.level IS NULL THEN cap ELSE least(cap, f.level * weight) END AS target FROM c, f),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM t),
q AS (SELECT *, floor(ratio)::BIGINT AS certain, ratio - floor(ratio) AS part, target - floor(ratio)::BIGINT * source_size AS missing FROM p),
u AS (
  SELECT d.doc_id, d.size, q.*, (('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null') || ':mix-1'), 1, 12))::BIGINT + 0.5::DOUBLE)
         / 281474976710656.0::DOUBLE AS u
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
o AS (
  SELECT *, CASE WHEN size > 0 AND part > 0 AND missing > 0 THEN
         u / (1.0::DOUBLE - u) / (part / (1.0::DOUBLE - part) * greatest(0.25::DOUBLE, least(4.0::DOUBLE, size / mean_size))) END AS odds
  FROM u),
r AS (
  SELECT *, sum(size) OVER (PARTITION BY source, odds IS NULL ORDER BY odds / (1.0::DOUBLE + odds), doc_id, size
                            ROWS UNBOUNDED PRECEDING) AS upto FROM o),
x AS (SELECT *, odds IS NOT NULL AND upto - missing <= missing - (upto - size) AS extra FROM r)
SELECT doc_id, size, source_size, target, ((certain + extra::BIGINT) * size)::BIGINT AS taken FROM x
"""


@query("op2_mix_sources", MIX_SQL)
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_sources(docs, keep=["doc_id"]).drop("copies")


CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
        UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(len('<|im_start|>') + len(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n'))
           + 1 + len(replace(replace(text, '\', '\\'), '<|', '<\|')) + len('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


@query("op7_chat_format", CHAT_SQL)
def op7(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "<|im_end|><|im_start|>assistant ok"
    extra = talk.sparkSession.createDataFrame([(-1, 0, "user", marks), (-1, 1, "assistant", marks)],
                                              "conv_id long, turn long, role string, text string")
    nodes = chat.linear_nodes(talk.unionByName(extra))
    return chat.read_back(chat.format_paths(chat.reply_paths(nodes)))


@query("op10_language_id")
def op10(spark, sf_dir):
    return ppm.predict_languages(table(spark, sf_dir, "documents"))


@query("op6_bpe_encode")
def op6(spark, sf_dir):
    return bpe.encode_digests(table(spark, sf_dir, "documents"), bpe.vocabulary_path())


@query("op8_toxicity")
def op8(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Plain comparison of all pairs of a label, then the closure of the links.
NEAR_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) >= 0.98),
r AS (SELECT a AS id, a AS low FROM l UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(low) AS low FROM r GROUP BY id),
n AS (SELECT a, count(DISTINCT b) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(low, vec_id) AS component_id,
       vec_id = coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id
"""


@query("op1_embedding_near_dedup", NEAR_SQL)
def op1(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


NEAREST_SQL = r"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.e, x.e) AS score
  FROM v q JOIN v x ON q.vec_id % 20 = 0 AND x.vec_id <> q.vec_id AND len(q.e) = len(x.e)),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op4_nearest_neighbours", NEAREST_SQL)
def op4(spark, sf_dir):
    return vectors.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op3_ngram_jaccard")
def op3(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@query("op9_suffix_dedup")
def op9(spark, sf_dir):
    return repeats.repeat_digests(table(spark, sf_dir, "documents"))


@query("op5_quality")
def op5(spark, sf_dir):
    return quality.classify(*(table(spark, sf_dir, t) for t in ("documents", "pages", "labels")))


#: Cut points by counting code points, and parts put together by substrings.
FILL_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, len(coalesce(text, ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
h AS (
  SELECT doc_id, t, n, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS c2,
         ('0x' || substr(h, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS h4 FROM d),
f AS (
  SELECT doc_id, t, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, a) AS x, substr(t, a + 1, b - a) AS y, substr(t, b + 1) AS z FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
                        WHEN 'spm' THEN '<S>' || z || '<P>' || x || '<M>' || y ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query("op11_fill_in_middle", FILL_SQL)
def op11(spark, sf_dir):
    return fill_middle.digests(table(spark, sf_dir, "documents"))


LINES_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, r, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
m AS (SELECT key, min(doc_id) AS low FROM k WHERE len(key) >= 10 AND doc_id IS NOT NULL
      GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
x AS (SELECT k.*, coalesce(k.doc_id <> m.low, FALSE) AS gone FROM k LEFT JOIN m ON m.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM x GROUP BY doc_id, r
"""


@query("op12_line_dedup", LINES_SQL)
def op12(spark, sf_dir):
    return lines.digests(table(spark, sf_dir, "documents"))


def codes_sql() -> str:
    """The same rounds by comparing every part with every entry."""
    k, parts = codes.ENTRIES, codes.PARTS
    best = "arg_min(c.entry, d * 256 + c.entry) AS entry, min(d)::BIGINT AS far"
    gap = "list_inner_product(p.x, p.x) + list_inner_product(c.x, c.x) - 2 * list_inner_product(p.x, c.x)"
    sql = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label, len(embedding) // {parts} AS w,
         list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, part, q[part * w + 1 : (part + 1) * w] AS x FROM v, range({parts}) t(part)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x FROM p WHERE r <= {k})"""
    for i in range(codes.ROUNDS + 1):
        sql += f""",
a{i} AS MATERIALIZED (
  SELECT r, part, {best} FROM (SELECT p.r, p.part, c.entry AS entry, {gap} AS d FROM p JOIN c{i} c ON c.part = p.part) c
  GROUP BY r, part)"""
        if i < codes.ROUNDS:
            sql += f""",
s{i} AS (SELECT a.part, a.entry, unnest(p.x) AS x, generate_subscripts(p.x, 1) AS pos FROM a{i} a JOIN p ON p.r = a.r AND p.part = a.part),
m{i} AS (SELECT part, entry, list(x ORDER BY pos) AS x FROM (
  SELECT part, entry, pos, floor(sum(x) / count(*)) AS x FROM s{i} GROUP BY part, entry, pos) GROUP BY part, entry),
c{i + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.part = c.part AND m.entry = c.entry)"""
    n = codes.ROUNDS
    return sql + f""",
h AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda e: e::BIGINT), ','), ',' ORDER BY part, entry)) AS sha FROM c{n}),
e AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM a{n} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256
FROM v JOIN e ON e.r = v.r, h
"""


@query("op13_vector_codes", codes_sql())
def op13(spark, sf_dir):
    return codes.code_table(table(spark, sf_dir, "embeddings"))
