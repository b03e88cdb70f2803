"""Syscall queries: cleaning, flags, argument tokens, TF-IDF and token statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from secflow.functions.columns import round_doubles
from secflow.operators import cleaning, flow_features, loading
from secflow.operators import tokens as tk
from secflow.plans.registry import query
from secflow.sources.readers import spread_scan
from secflow.sources.views import ARGS_SQL, SYSCALL_SQL, TOKENS_SQL, syscall_view, table

WE = f"WITH {SYSCALL_SQL} "
WT = f"WITH {SYSCALL_SQL}, {ARGS_SQL}, {TOKENS_SQL} "
_CASES = """CAST(CASE WHEN processId IN (0, 1, 2) THEN 1 ELSE 0 END AS INTEGER) AS processId_flag,
CASE WHEN parentProcessId IN (0, 1, 2) THEN 1 ELSE 0 END AS parentProcessId_flag,
CASE WHEN userId < 1000 THEN 1 ELSE 0 END AS userId_flag,
CASE WHEN mountNamespace = 4026531840 THEN 1 ELSE 0 END AS mountNamespace_flag,
CAST(sign(returnValue) AS INTEGER) AS returnValue_flag"""
_HOST = "CAST((SELECT count(*) FROM (SELECT DISTINCT hostName AS h FROM syscalls) WHERE h < hostName) AS INTEGER) AS hostName"
_HOSTS = ", hosts AS (SELECT hostName AS h, CAST(row_number() OVER (ORDER BY hostName) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT hostName FROM syscalls)) "
_KEPT = "row_id, userId, mountNamespace, code AS hostName, eventId, argsNum, returnValue, k, value, sus, evil, split"


def _tokens(spark, sf_dir):
    calls = syscall_view(spark, sf_dir).select("row_id", "sus", "evil", "split", "args")
    return tk.parse_args(calls).withColumn("tokens", tk.tokens_of(F.col("args")))


@query("C1 C2 C5 C6 C7 C8 C9 S1", WE + _HOSTS + f"""SELECT timestamp AS timeSinceBoot, processId, parentProcessId, {_KEPT}, {_CASES}
FROM syscalls JOIN hosts ON h = hostName""")
def syscall_clean(spark, sf_dir):
    """Renamed, flagged, trimmed and coded call records."""
    return cleaning.clean_syscalls(syscall_view(spark, sf_dir)).drop("args")


@query("F23", WE + _HOSTS + f"""SELECT round(ln(1 + timestamp), 9) AS log_timeSinceBoot, round(ln(1 + processId), 9) AS log_processId,
round(ln(1 + parentProcessId), 9) AS log_parentProcessId, {_KEPT}, {_CASES} FROM syscalls JOIN hosts ON h = hostName""")
def syscall_log_features(spark, sf_dir):
    return round_doubles(flow_features.log_syscalls(cleaning.clean_syscalls(syscall_view(spark, sf_dir)).drop("args")), 9)


_SCALED = ["userId", "mountNamespace", "eventId", "argsNum", "returnValue", "k", "value"]
_LOGS = {"log_timeSinceBoot": "timestamp", "log_processId": "processId", "log_parentProcessId": "parentProcessId"}


@query("S5 Z1 Z3", WE + _HOSTS + ", l AS (SELECT *, " + ", ".join(f"ln(1 + {b}) AS {n}" for n, b in _LOGS.items()) + " FROM syscalls JOIN hosts ON h = hostName), f AS (SELECT "
       + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in [*_SCALED, *_LOGS]) + " FROM l WHERE split = 'train') SELECT row_id, sus, evil, split, code AS hostName, "
       + _CASES + ", " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in [*_SCALED, *_LOGS]) + " FROM l, f")
def syscall_ready(spark, sf_dir):
    """The one-call load: clean, log, scale with train statistics."""
    return round_doubles(loading.prepare_syscalls(syscall_view(spark, sf_dir)).drop("args"))


@query("T1 T2 T3", WT + """SELECT row_id, list_transform(args, lambda a: a.name) AS arg_names, list_transform(args, lambda a: a.type) AS arg_types,
list_transform(args, lambda a: a.value) AS arg_values,
array_to_string(list_transform(args, lambda a: a.name || '=' || a.value || '(' || a.type || ')'), '|||') AS args_str FROM call_args""")
def argument_arrays(spark, sf_dir):
    calls = tk.parse_args(syscall_view(spark, sf_dir).select("row_id", "args"))
    return tk.argument_arrays(calls).drop("args")


@query("T4 C17", WT + "SELECT term, count(*) AS uses FROM tokens GROUP BY term")
def token_uses(spark, sf_dir):
    """Tokens split out of the joined strings, then counted."""
    joined = tk.argument_arrays(tk.parse_args(syscall_view(spark, sf_dir).select("row_id", "args")))
    words = joined.withColumn("tokens", tk.split_tokens(F.col("args_str")))
    return tk.drop_text_columns(words).select(F.explode("tokens").alias("term")).groupBy("term").agg(F.count("*").alias("uses"))


def _vocabulary(source: str, n: str, k: int, where: str) -> str:
    return f""", tf AS (SELECT row_id, term, count(*) AS tf FROM {source} GROUP BY 1, 2),
n AS (SELECT {n} AS n), vocab AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf, ln((1 + n) / (1 + count(*))) + 1 AS idf
FROM tf, n {where} GROUP BY term, n HAVING count(*) >= 2 AND count(*) <= 0.5 * n ORDER BY sum(tf) DESC, term LIMIT {k}) """


_DOCS = "WITH words AS (SELECT doc_id AS row_id, unnest(string_split_regex(trim(text), '\\s+')) AS term FROM documents) "


@query("T5 T6", _DOCS + _vocabulary("words", "(SELECT count(*) FROM documents)", 500, "")
       + "SELECT term, df, tf, round(idf, 9) AS idf, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS index FROM vocab")
def text_vocabulary(spark, sf_dir):
    """Vocabulary of whole document texts."""
    return round_doubles(tk.fit_vocabulary(_documents(spark, sf_dir), "tokens", "row_id", 500), 9)


def _documents(spark, sf_dir):
    words = F.split(F.trim("text"), r"\s+")
    return spread_scan(table(spark, sf_dir, "documents"), "doc_id").select(F.col("doc_id").alias("row_id"), words.alias("tokens"))


@query("T7", _DOCS + _vocabulary("words", "(SELECT count(*) FROM documents)", 500, "") + """SELECT row_id, term, tf.tf, round(idf, 9) AS idf,
round(tf.tf * idf / sqrt(sum((tf.tf * idf) ** 2) OVER (PARTITION BY row_id)), 9) AS weight FROM tf JOIN vocab USING (term)""")
def text_tfidf(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return round_doubles(tk.tfidf(docs, "tokens", tk.fit_vocabulary(docs, "tokens", "row_id", 500)), 9)


_CALLS = _vocabulary("tokens", "(SELECT count(*) FROM syscalls WHERE split = 'train')", 60, "WHERE row_id IN (SELECT row_id FROM syscalls WHERE split = 'train')")
_WEIGHTS = _CALLS + """, weights AS (SELECT row_id, term, tf.tf * idf / sqrt(sum((tf.tf * idf) ** 2) OVER (PARTITION BY row_id)) AS weight
FROM tf JOIN vocab USING (term)), lab AS (SELECT w.*, sus FROM weights w JOIN syscalls USING (row_id)),
z AS (SELECT count(*) FILTER (sus = 0) AS n0, count(*) FILTER (sus = 1) AS n1 FROM syscalls) """


def _weights(spark, sf_dir):
    calls = _tokens(spark, sf_dir)
    vocabulary = tk.fit_vocabulary(calls.filter("split = 'train'"), "tokens", "row_id", 60)
    return calls, vocabulary, tk.tfidf(calls, "tokens", vocabulary)


@query("T7 T8", WT + _WEIGHTS + """SELECT (SELECT count(*) FROM syscalls) AS rows, (SELECT count(*) FROM vocab) AS terms, count(*) AS nnz,
round(100 * (1 - count(*) / ((SELECT count(*) FROM syscalls) * (SELECT count(*) FROM vocab))), 6) AS sparsity_pct FROM weights""")
def argument_matrix_stats(spark, sf_dir):
    """Vocabulary fitted on train rows, weights for all rows."""
    calls, vocabulary, weights = _weights(spark, sf_dir)
    return round_doubles(tk.matrix_stats(weights, calls, vocabulary))


_CATEGORY = """CASE WHEN regexp_matches(lower(term), 'dir|file|dev|sys') THEN 'File/Path' WHEN regexp_matches(lower(term), 'exec') THEN 'Process'
WHEN regexp_matches(lower(term), 'uid|gid') THEN 'Permissions' WHEN regexp_matches(lower(term), 'addr|sock') THEN 'Network'
WHEN regexp_matches(lower(term), 'stack|mem') THEN 'Memory' ELSE 'Other' END"""
_ENRICHED = WT + _WEIGHTS + f""", e AS (SELECT term AS argument, 100 * count(*) FILTER (sus = 0) / n0 AS a, 100 * count(*) FILTER (sus = 1) / n1 AS b,
coalesce(sum(weight) FILTER (sus = 0), 0) / n0 AS c, coalesce(sum(weight) FILTER (sus = 1), 0) / n1 AS d, {_CATEGORY} AS category FROM lab, z GROUP BY term, n0, n1) """


@query("T10 T13", _ENRICHED + """SELECT argument, round(a, 6) AS normal_prevalence_pct, round(b, 6) AS anomaly_prevalence_pct,
round(b / nullif(a, 0), 6) AS enrichment_ratio, round(c, 6) AS normal_mean_tfidf, round(d, 6) AS anomaly_mean_tfidf,
round(d - c, 6) AS tfidf_difference, category FROM e""")
def token_enrichment(spark, sf_dir):
    calls, _, weights = _weights(spark, sf_dir)
    return round_doubles(tk.token_enrichment(weights, calls, "sus"))


@query("T14", _ENRICHED + """SELECT category, count(*) AS count, round(avg(b / nullif(a, 0)), 2) AS avg_enrichment,
round(avg(b), 2) AS avg_anomaly_prevalence_pct, round(avg(d - c), 2) AS avg_tfidf_diff FROM e GROUP BY category""")
def token_category_stats(spark, sf_dir):
    calls, _, weights = _weights(spark, sf_dir)
    return tk.category_stats(tk.token_enrichment(weights, calls, "sus"))


_ASSOC = WT + _WEIGHTS + """, s AS (SELECT term, n0, n1, n0 + n1 AS n, sum(weight) AS w, sum(weight * weight) AS ww,
coalesce(sum(weight) FILTER (sus = 1), 0) AS w1 FROM lab, z GROUP BY term, n0, n1),
a AS (SELECT *, abs((n * w1 - w * n1) / sqrt((n * ww - w * w) * (n * n1 - n1 * n1))) AS r FROM s) """


@query("T11", _ASSOC + """SELECT term AS feature, round(r, 6) AS correlation, round((w - w1) / n0, 6) AS normal_mean, round(w1 / n1, 6) AS anomaly_mean,
round(w1 / n1 - (w - w1) / n0, 6) AS difference FROM a""")
def token_association(spark, sf_dir):
    calls, _, weights = _weights(spark, sf_dir)
    return round_doubles(tk.token_association(weights, calls, "sus").drop("p_value"))


@query("T12", _ASSOC + "SELECT term AS feature, CAST(row_number() OVER (ORDER BY r DESC, term) AS INTEGER) AS rank FROM a ORDER BY r DESC, term LIMIT 10")
def top_tokens(spark, sf_dir):
    calls, _, weights = _weights(spark, sf_dir)
    return tk.top_tokens(tk.token_association(weights, calls, "sus"), 10)


@query("T9 J1")
def syscall_vectors(spark, sf_dir):
    """Numeric columns and TF-IDF weights of every call in one sparse vector."""
    from pyspark.ml.functions import vector_to_array

    ready = loading.prepare_syscall_vectors(syscall_view(spark, sf_dir), 60)
    arr = vector_to_array("features")
    return ready.select("row_id", F.size(arr).alias("width"), F.round(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), 4).alias("total"))
