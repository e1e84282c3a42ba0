"""Filter queries (F1-F24, F26) and gate metrics (A4-A6) over the ``changes`` feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.fixtures import changes
from tributary.functions.envelope import subject
from tributary.operators import filters as flt
from tributary.operators.metrics import gateway_stats, filter_rate, rejections_by_filter
from tributary.workloads.registry import register


# ------------------------------------------------------------ SQL helpers

def _jx(path: str) -> str:
    return f"json_extract(source, '$.{path}')"


def _jt(path: str) -> str:
    return f"json_type({_jx(path)})"


def _missing(path: str) -> str:
    return f"(source IS NULL OR {_jx(path)} IS NULL)"


def _field(path: str, present_expr: str, exists: bool = False) -> str:
    miss = "false" if exists else "NULL"
    return f"(CASE WHEN {_missing(path)} THEN {miss} ELSE ({present_expr}) END)"


_INT = "('UBIGINT','BIGINT')"


# ------------------------------------------------------------ index / operation

@register("f1_index_exact", """
SELECT sequence, index,
  (index NOT IN ('temp_view') AND index IN ('app-click', 'app-purchase', 'temp_error')) AS decision
FROM changes""")
def f1_index_exact(spark, sf_dir):
    f = flt.IndexFilter(include=("app-click", "app-purchase", "temp_error"), exclude=("temp_view",))
    return changes(spark, sf_dir).select("sequence", "index", f.column().alias("decision"))


_GLOBS = {  # pattern -> output column
    "app-*": "g_prefix",
    "*_error": "g_suffix",
    "app*view": "g_inner",
    "temp_*r": "g_inner2",
    "*a*": "g_star_both",
    "a*p*k": "g_two_stars",
    "*": "g_all",
    "app-signup": "g_exact",
}


@register("f2_index_glob", """
SELECT sequence, index,
  starts_with(index, 'app-') AS g_prefix,
  ends_with(index, '_error') AS g_suffix,
  (starts_with(index, 'app') AND ends_with(index, 'view')) AS g_inner,
  (starts_with(index, 'temp_') AND ends_with(index, 'r')) AS g_inner2,
  starts_with(index, '*a') AS g_star_both,
  (index = 'a*p*k') AS g_two_stars,
  true AS g_all,
  (index = 'app-signup') AS g_exact
FROM changes""")
def f2_index_glob(spark, sf_dir):
    c = changes(spark, sf_dir)
    return c.select("sequence", "index",
                    *[flt.glob_match(F.col("index"), p).alias(n) for p, n in _GLOBS.items()])


@register("f3_index_filter", """
SELECT sequence, index,
  (index NOT IN ('temp_view') AND NOT ends_with(index, 'error')
   AND (index IN ('app-click') OR starts_with(index, 'temp_'))) AS decision,
  (NOT ends_with(index, 'error')) AS decision_exclude_only
FROM changes""")
def f3_index_filter(spark, sf_dir):
    full = flt.IndexFilter(include=("app-click",), include_patterns=("temp_*",),
                           exclude=("temp_view",), exclude_patterns=("*error",))
    excl = flt.IndexFilter(exclude_patterns=("*error",))
    return changes(spark, sf_dir).select("sequence", "index", full.column().alias("decision"),
                                         excl.column().alias("decision_exclude_only"))


@register("f4_operation", """
SELECT sequence, operation,
  (operation NOT IN ('update') AND operation IN ('index', 'update', 'delete')) AS decision,
  (operation NOT IN ('delete')) AS decision_exclude
FROM changes""")
def f4_operation(spark, sf_dir):
    f = flt.OperationFilter(include=("index", "update", "delete"), exclude=("update",))
    g = flt.OperationFilter(exclude=("delete",))
    return changes(spark, sf_dir).select("sequence", "operation", f.column().alias("decision"),
                                         g.column().alias("decision_exclude"))


@register("f5_writes_only", """
SELECT sequence, operation, operation IN ('index', 'update', 'partial_update') AS decision
FROM changes""")
def f5_writes_only(spark, sf_dir):
    return changes(spark, sf_dir).select("sequence", "operation",
                                         flt.writes_only().column().alias("decision"))


# ------------------------------------------------------------ subject

_SUBJ_SQL = """concat('es.acme.', replace(index, '-', '_'), '.',
  CASE WHEN operation = 'partial_update' THEN 'partial' ELSE operation END)"""


@register("f6_subject", f"""
SELECT sequence, {_SUBJ_SQL} AS subject,
  (replace(index, '-', '_') = 'app_click' OR operation = 'partial_update'
   OR replace(index, '-', '_') = 'temp_view') AS decision,
  true AS d_any_tail,
  false AS d_too_short,
  (replace(index, '-', '_') LIKE 'app%') AND false AS d_literal_star,
  CAST(NULL AS BOOLEAN) AS d_no_patterns
FROM changes""")
def f6_subject(spark, sf_dir):
    c = changes(spark, sf_dir)
    main = flt.SubjectFilter("acme", ("es.acme.app_click.*", "es.acme.*.partial", "es.acme.temp_view.>"))
    any_tail = flt.SubjectFilter("acme", (">",))
    too_short = flt.SubjectFilter("acme", ("es.acme.*",))
    literal_star = flt.SubjectFilter("acme", ("es.acme.app*.index",))
    none = flt.SubjectFilter("acme", ())
    return c.select("sequence", subject("acme").alias("subject"), main.column().alias("decision"),
                    any_tail.column().alias("d_any_tail"), too_short.column().alias("d_too_short"),
                    literal_star.column().alias("d_literal_star"),
                    none.column().alias("d_no_patterns"))


# ------------------------------------------------------------ field predicates

@register("f7_field_exists", f"""
SELECT sequence, {_field('flag', 'true', exists=True)} AS has_flag,
  {_field('meta.uid', 'true', exists=True)} AS has_uid,
  {_field('meta.tags[1]', 'true', exists=True)} AS has_tag1,
  {_field('meta.tags[2]', 'true', exists=True)} AS has_tag2,
  {_field('nope', 'true', exists=True)} AS has_nope
FROM changes""")
def f7_field_exists(spark, sf_dir):
    c = changes(spark, sf_dir)
    cols = {"has_flag": "flag", "has_uid": "meta.uid", "has_tag1": "meta.tags.1",
            "has_tag2": "meta.tags.2", "has_nope": "nope"}
    return flt.results(c, {n: flt.FieldFilter(p, "exists") for n, p in cols.items()}, "sequence")


@register("f8_field_eq", f"""
SELECT sequence,
  {_field('k', f"{_jt('k')} IN {_INT} AND TRY_CAST({_jx('k')} AS BIGINT) = 42")} AS eq_k,
  {_field('k', f"{_jt('k')} = 'DOUBLE' AND TRY_CAST({_jx('k')} AS DOUBLE) = 42.0")} AS eq_k_float,
  {_field('type', f"{_jt('type')} = 'VARCHAR' AND json_extract_string(source, '$.type') = 'click'")} AS eq_type,
  {_field('flag', f"{_jt('flag')} = 'NULL'")} AS eq_flag_null,
  {_field('flag', f"{_jt('flag')} = 'BOOLEAN' AND TRY_CAST({_jx('flag')} AS BOOLEAN) = true")} AS eq_flag_true,
  {_field('meta.uid', f"{_jt('meta.uid')} IN {_INT} AND TRY_CAST({_jx('meta.uid')} AS BIGINT) = 8")} AS eq_uid,
  {_field('meta.tags', f"{_jt('meta.tags')} = 'ARRAY' AND {_jx('meta.tags')}::VARCHAR = '[\"click\",\"t1\"]'")} AS eq_tags,
  {_field('k', f"{_jt('k')} = 'VARCHAR' AND json_extract_string(source, '$.k') = '42'")} AS eq_k_text
FROM changes""")
def f8_field_eq(spark, sf_dir):
    c = changes(spark, sf_dir)
    specs = {"eq_k": ("k", 42), "eq_k_float": ("k", 42.0), "eq_type": ("type", "click"),
             "eq_flag_null": ("flag", None), "eq_flag_true": ("flag", True), "eq_uid": ("meta.uid", 8),
             "eq_tags": ("meta.tags", ["click", "t1"]), "eq_k_text": ("k", "42")}
    return flt.results(c, {n: flt.FieldFilter(p, "equals", v) for n, (p, v) in specs.items()}, "sequence")


@register("f9_field_ne", f"""
SELECT sequence,
  {_field('type', f"NOT ({_jt('type')} = 'VARCHAR' AND json_extract_string(source, '$.type') = 'view')")} AS ne_type,
  {_field('flag', f"NOT ({_jt('flag')} = 'BOOLEAN' AND TRY_CAST({_jx('flag')} AS BOOLEAN) = true)")} AS ne_flag
FROM changes""")
def f9_field_ne(spark, sf_dir):
    c = changes(spark, sf_dir)
    return flt.results(c, {"ne_type": flt.FieldFilter("type", "not_equals", "view"),
                           "ne_flag": flt.FieldFilter("flag", "not_equals", True)}, "sequence")


def _str_pred(path: str, cond: str) -> str:
    return _field(path, f"{_jt(path)} = 'VARCHAR' AND coalesce({cond}, false)")


@register("f10_field_contains", f"""
SELECT sequence,
  {_str_pred('type', "contains(json_extract_string(source, '$.type'), 'ck')")} AS c_type,
  {_str_pred('k', "contains(json_extract_string(source, '$.k'), '4')")} AS c_number,
  {_str_pred('meta.tags[1]', "contains(json_extract_string(source, '$.meta.tags[1]'), 't')")} AS c_tag
FROM changes""")
def f10_field_contains(spark, sf_dir):
    c = changes(spark, sf_dir)
    return flt.results(c, {"c_type": flt.FieldFilter("type", "contains", "ck"),
                           "c_number": flt.FieldFilter("k", "contains", "4"),
                           "c_tag": flt.FieldFilter("meta.tags.1", "contains", "t")}, "sequence")


@register("f11_field_matches", f"""
SELECT sequence,
  {_str_pred('type', "contains(json_extract_string(source, '$.type'), 'ic')")} AS m_substring,
  {_str_pred('type', "contains(json_extract_string(source, '$.type'), '^c')")} AS m_caret_literal,
  {_str_pred('type', "regexp_matches(json_extract_string(source, '$.type'), '^c.*k$')")} AS m_regex
FROM changes""")
def f11_field_matches(spark, sf_dir):
    c = changes(spark, sf_dir)
    return flt.results(c, {"m_substring": flt.FieldFilter("type", "matches", "ic"),
                           "m_caret_literal": flt.FieldFilter("type", "matches", "^c"),
                           "m_regex": flt.FieldFilter("type", "matches", "^c.*k$", regex=True)}, "sequence")


def _num_pred(path: str, op: str, t: float) -> str:
    return _field(path, f"{_jt(path)} IN ('UBIGINT','BIGINT','DOUBLE') AND TRY_CAST({_jx(path)} AS DOUBLE) {op} {t}")


@register("f12_field_gt", f"""
SELECT sequence, {_num_pred('value', '>', 250.0)} AS gt_value,
  {_num_pred('k', '>', 50.5)} AS gt_k, {_num_pred('type', '>', 0.0)} AS gt_type,
  {_num_pred('flag', '>', 0.0)} AS gt_flag
FROM changes""")
def f12_field_gt(spark, sf_dir):
    c = changes(spark, sf_dir)
    return flt.results(c, {"gt_value": flt.FieldFilter("value", "greater_than", 250.0),
                           "gt_k": flt.FieldFilter("k", "greater_than", 50.5),
                           "gt_type": flt.FieldFilter("type", "greater_than", 0.0),
                           "gt_flag": flt.FieldFilter("flag", "greater_than", 0.0)}, "sequence")


@register("f13_field_lt", f"""
SELECT sequence, {_num_pred('value', '<', 10.0)} AS lt_value, {_num_pred('meta.uid', '<', 20)} AS lt_uid
FROM changes""")
def f13_field_lt(spark, sf_dir):
    c = changes(spark, sf_dir)
    return flt.results(c, {"lt_value": flt.FieldFilter("value", "less_than", 10.0),
                           "lt_uid": flt.FieldFilter("meta.uid", "less_than", 20)}, "sequence")


@register("f14_field_in", f"""
SELECT sequence,
  {_field('type', f"{_jt('type')} = 'VARCHAR' AND json_extract_string(source, '$.type') IN ('click', 'view')")} AS in_type,
  {_field('k', f"{_jt('k')} IN {_INT} AND TRY_CAST({_jx('k')} AS BIGINT) IN (1, 2, 3, 42)")} AS in_k,
  {_field('flag', f"{_jt('flag')} = 'NULL' OR ({_jt('flag')} = 'BOOLEAN' AND TRY_CAST({_jx('flag')} AS BOOLEAN) = false)")} AS in_flag
FROM changes""")
def f14_field_in(spark, sf_dir):
    c = changes(spark, sf_dir)
    return flt.results(c, {"in_type": flt.FieldFilter("type", "in", ["click", "view"]),
                           "in_k": flt.FieldFilter("k", "in", [1, 2, 3, 42]),
                           "in_flag": flt.FieldFilter("flag", "in", [None, False])}, "sequence")


@register("f15_missing_abstain", f"""
SELECT operation, source IS NULL AS no_body,
  CAST(count(*) AS BIGINT) AS n,
  CAST(count_if({_field('nope', 'true', exists=True)}) AS BIGINT) AS n_exists_pass,
  CAST(count_if({_field('nope', 'false')} IS NULL) AS BIGINT) AS n_eq_abstain,
  CAST(count_if({_field('flag', 'true', exists=True)} = false) AS BIGINT) AS n_flag_exists_reject,
  CAST(count_if({_num_pred('flag', '>', 0.0)} IS NULL) AS BIGINT) AS n_flag_gt_abstain
FROM changes GROUP BY operation, source IS NULL""")
def f15_missing_abstain(spark, sf_dir):
    c = changes(spark, sf_dir)
    return (flt.results(c, {"e": flt.FieldFilter("nope", "exists"), "q": flt.FieldFilter("nope", "equals", 1),
                            "fe": flt.FieldFilter("flag", "exists"), "fg": flt.FieldFilter("flag", "greater_than", 0.0)},
                        "operation", F.col("source").isNull().alias("no_body"))
            .groupBy("operation", "no_body")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("e")).alias("n_exists_pass"),
                 F.count_if(F.col("q").isNull()).alias("n_eq_abstain"),
                 F.count_if(F.col("fe") == F.lit(False)).alias("n_flag_exists_reject"),
                 F.count_if(F.col("fg").isNull()).alias("n_flag_gt_abstain")))


# ------------------------------------------------------------ three-valued algebra

# a: flag == true  (true -> Pass, null -> Reject, absent / no body -> Abstain)
# b: a user filter on k bands (k >= 67 Pass, k < 34 Reject, else Abstain; no body Abstain)
_A_SQL = _field("flag", f"{_jt('flag')} = 'BOOLEAN' AND TRY_CAST({_jx('flag')} AS BOOLEAN) = true")
_K_SQL = "CAST(regexp_extract(source, '\"k\":([0-9]+)', 1) AS BIGINT)"
_B_SQL = f"(CASE WHEN source IS NULL THEN NULL WHEN {_K_SQL} >= 67 THEN true WHEN {_K_SQL} < 34 THEN false END)"


def _ab(spark, sf_dir):
    c = changes(spark, sf_dir)
    a = flt.FieldFilter("flag", "equals", True, name="flag_true")
    k = F.regexp_extract("source", '"k":([0-9]+)', 1).cast("bigint")
    b = flt.ColumnFilter("k_band", lambda: F.when(F.col("source").isNull(), F.lit(None).cast("boolean"))
                         .when(k >= 67, F.lit(True)).when(k < 34, F.lit(False)))
    return c, a, b


@register("f16_tri_and", f"""
SELECT sequence, a, b,
  CASE WHEN a = false OR b = false THEN false ELSE coalesce(a, b) END AS a_and_b
FROM (SELECT sequence, {_A_SQL} AS a, {_B_SQL} AS b FROM changes) t""")
def f16_tri_and(spark, sf_dir):
    c, a, b = _ab(spark, sf_dir)
    t = flt.results(c, {"a": a, "b": b}, "sequence")
    return t.select("sequence", "a", "b", flt.tri_and(F.col("a"), F.col("b")).alias("a_and_b"))


@register("f17_tri_or", f"""
SELECT sequence, a, b, (a OR b) AS a_or_b
FROM (SELECT sequence, {_A_SQL} AS a, {_B_SQL} AS b FROM changes) t""")
def f17_tri_or(spark, sf_dir):
    c, a, b = _ab(spark, sf_dir)
    t = flt.results(c, {"a": a, "b": b}, "sequence")
    return t.select("sequence", "a", "b", flt.tri_or(F.col("a"), F.col("b")).alias("a_or_b"))


@register("f18_passes", f"""
SELECT CAST(count_if(coalesce({_A_SQL}, true)) AS BIGINT) AS n_pass_a,
       CAST(count_if(coalesce({_B_SQL}, true)) AS BIGINT) AS n_pass_b,
       CAST(count(*) AS BIGINT) AS n
FROM changes""")
def f18_passes(spark, sf_dir):
    c, a, b = _ab(spark, sf_dir)
    return flt.results(c, {"a": a, "b": b}).agg(F.count_if(flt.passes(F.col("a"))).alias("n_pass_a"),
                                                F.count_if(flt.passes(F.col("b"))).alias("n_pass_b"),
                                                F.count(F.lit(1)).alias("n"))


def _chain_filters():
    return [flt.IndexFilter(include_patterns=("app-*",), exclude=("app-error",)),
            flt.writes_only(),
            flt.FieldFilter("flag", "equals", True)]


_I_SQL = "(index NOT IN ('app-error') AND starts_with(index, 'app-'))"
_O_SQL = "(operation IN ('index', 'update', 'partial_update'))"


@register("f19_chain_all", f"""
SELECT sequence, d AS decision, coalesce(d, true) AS passed,
  CASE WHEN NOT {_I_SQL} THEN 'index_filter' WHEN NOT {_O_SQL} THEN 'operation_filter'
       WHEN {_A_SQL} = false THEN 'field_filter' END AS rejected_by
FROM (SELECT *, ({_I_SQL} AND {_O_SQL} AND coalesce({_A_SQL}, true)) AS d FROM changes) t""")
def f19_chain_all(spark, sf_dir):
    chain = flt.FilterChain(_chain_filters(), "all")
    g = flt.gate(changes(spark, sf_dir), chain)
    return g.select("sequence", "decision", "passed", "rejected_by")


@register("f20_chain_any", f"""
SELECT sequence, d AS decision, coalesce(d, true) AS passed
FROM (SELECT *, ({_I_SQL} OR {_O_SQL} OR {_A_SQL}) AS d FROM changes) t""")
def f20_chain_any(spark, sf_dir):
    chain = flt.FilterChain(list(reversed(_chain_filters())), "any")
    return flt.gate(changes(spark, sf_dir), chain).select("sequence", "decision", "passed")


@register("f21_chain_first", f"""
SELECT sequence, d AS decision, coalesce(d, true) AS passed
FROM (SELECT *, coalesce({_A_SQL}, {_B_SQL}, {_O_SQL}) AS d FROM changes) t""")
def f21_chain_first(spark, sf_dir):
    c, a, b = _ab(spark, sf_dir)
    chain = flt.FilterChain([a, b, flt.writes_only()], "first")
    return flt.gate(c, chain).select("sequence", "decision", "passed")


@register("f22_empty_chain", """
SELECT sequence, true AS empty_all, true AS empty_any, true AS empty_first,
  true AS disabled_all, false AS disabled_any, CAST(NULL AS BOOLEAN) AS disabled_first,
  (operation IN ('index', 'update', 'partial_update')) AS one_disabled_all
FROM changes""")
def f22_empty_chain(spark, sf_dir):
    c = changes(spark, sf_dir)
    cols = []
    for mode in ("all", "any", "first"):
        cols.append(flt.FilterChain([], mode).decision().alias(f"empty_{mode}"))
    for mode in ("all", "any", "first"):
        off = [flt.IndexFilter(include=("nothing",)).disabled(), flt.writes_only().disabled()]
        cols.append(flt.FilterChain(off, mode).decision().alias(f"disabled_{mode}"))
    mixed = flt.FilterChain([flt.IndexFilter(include=("nothing",)).disabled(), flt.writes_only()], "all")
    cols.append(mixed.decision().alias("one_disabled_all"))
    return c.select("sequence", *cols)


_SPEC = {
    "mode": "all",
    "filters": [
        {"type": "index", "include_patterns": ["app-*", "temp_*"], "exclude_patterns": ["*_signup"]},
        {"type": "operation", "exclude": ["delete"]},
        {"type": "subject", "tenant": "acme", "patterns": ["es.acme.*.index", "es.acme.*.update"]},
        {"type": "field", "path": "value", "predicate": {"greater_than": 100.0}},
        {"type": "field", "path": "flag", "predicate": "exists", "enabled": False},
    ],
}


@register("f23_spec_chain", f"""
SELECT sequence, (starts_with(index, 'app-') OR starts_with(index, 'temp_'))
  AND NOT ends_with(index, '_signup') AND operation <> 'delete'
  AND operation IN ('index', 'update')
  AND coalesce({_num_pred('value', '>', 100.0)}, true) AS decision
FROM changes""")
def f23_spec_chain(spark, sf_dir):
    chain = flt.chain_from_spec(_SPEC)
    return flt.gate(changes(spark, sf_dir), chain).select("sequence", "decision")


@register("f24_build_filters", """
SELECT sequence,
  (index NOT IN ('app-view') AND NOT ends_with(index, '_error')
   AND (index IN ('app-click') OR starts_with(index, 'temp_'))
   AND operation IN ('index', 'partial_update')) AS decision,
  (NOT ends_with(index, '_error') AND index IN ('app-click', 'temp_*')
   AND operation IN ('index')) AS decision_compat,
  true AS decision_compat_unknown_ops
FROM changes""")
def f24_build_filters(spark, sf_dir):
    kw = dict(include_indices=["app-click", "temp_*"], exclude_indices=["app-view"],
              exclude_patterns=["*_error"], include_operations=["index", "partial"])
    fixed = flt.build_filters(**kw)
    compat = flt.build_filters(**kw, compat=True)
    unknown = flt.build_filters(include_operations=["upsert", "partial"], compat=True)
    return changes(spark, sf_dir).select("sequence", fixed.decision().alias("decision"),
                                         compat.decision().alias("decision_compat"),
                                         unknown.decision().alias("decision_compat_unknown_ops"))


@register("f26_gate_split", f"""
SELECT coalesce(d, true) AS passed, rejected_by, CAST(count(*) AS BIGINT) AS n
FROM (SELECT ({_I_SQL} AND {_O_SQL} AND coalesce({_A_SQL}, true)) AS d,
  CASE WHEN NOT {_I_SQL} THEN 'index_filter' WHEN NOT {_O_SQL} THEN 'operation_filter'
       WHEN {_A_SQL} = false THEN 'field_filter' END AS rejected_by FROM changes) t
GROUP BY 1, 2""")
def f26_gate_split(spark, sf_dir):
    g = flt.gate(changes(spark, sf_dir), flt.FilterChain(_chain_filters(), "all"))
    return g.groupBy("passed", "rejected_by").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------ gate metrics

_GATE_SQL = f"({_I_SQL} AND {_O_SQL} AND coalesce({_A_SQL}, true))"


@register("a4_gateway_stats", f"""
SELECT CAST(count(*) AS BIGINT) AS received, CAST(count_if(NOT {_GATE_SQL}) AS BIGINT) AS filtered,
       CAST(count_if({_GATE_SQL}) AS BIGINT) AS forwarded
FROM changes""")
def a4_gateway_stats(spark, sf_dir):
    g = flt.gate(changes(spark, sf_dir), flt.FilterChain(_chain_filters(), "all"))
    return gateway_stats(g)


@register("a5_filter_rate", f"""
SELECT index, CAST(count(*) AS BIGINT) AS received, CAST(count_if(NOT {_GATE_SQL}) AS BIGINT) AS filtered,
  CASE WHEN count(*) > 0 THEN CAST(count_if(NOT {_GATE_SQL}) AS DOUBLE) / count(*) * 100.0 ELSE 0.0 END AS filter_rate
FROM changes GROUP BY index""")
def a5_filter_rate(spark, sf_dir):
    g = flt.gate(changes(spark, sf_dir), flt.FilterChain(_chain_filters(), "all"))
    return filter_rate(g, by=("index",))


@register("a6_rejected_by", f"""
SELECT rejected_by, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN NOT {_I_SQL} THEN 'index_filter' WHEN NOT {_O_SQL} THEN 'operation_filter'
       WHEN {_A_SQL} = false THEN 'field_filter' END AS rejected_by FROM changes) t
WHERE rejected_by IS NOT NULL GROUP BY rejected_by""")
def a6_rejected_by(spark, sf_dir):
    g = flt.gate(changes(spark, sf_dir), flt.FilterChain(_chain_filters(), "all"))
    return rejections_by_filter(g)
