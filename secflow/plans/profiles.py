"""Profile queries over the flow, syscall and score views and raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from secflow.functions.columns import round_doubles
from secflow.operators import profiling as pr
from secflow.operators.cleaning import drop_incomplete_rows
from secflow.operators.flow_features import log_flows
from secflow.plans.registry import query
from secflow.sources.views import FLOW_SQL, SCORES_SQL, SYSCALL_SQL, flow_view, score_view, syscall_view, table

WF = f"WITH {FLOW_SQL} "
WE = f"WITH {SYSCALL_SQL} "
WS = f"WITH {SCORES_SQL} "
NUMS = ["sbytes", "dbytes", "spkts", "sjit", "dload"]


def _union(template: str, columns=NUMS) -> str:
    return " UNION ALL ".join(template.replace("@", c) for c in columns)


def _flow(spark, sf_dir):
    return flow_view(spark, sf_dir).select("label", *NUMS)


@query("A1", """SELECT count(*) AS rows, CAST(6 AS BIGINT) AS columns, CAST(2 AS BIGINT) AS columns_bigint, CAST(1 AS BIGINT) AS columns_double,
CAST(2 AS BIGINT) AS columns_string, CAST(1 AS BIGINT) AS columns_timestamp_ntz FROM events""")
def table_shape(spark, sf_dir):
    return pr.table_shape(table(spark, sf_dir, "events"))


@query("A2", """SELECT 'quality' AS column, count(*) FILTER (quality IS NULL) AS null_count FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM documents LEFT JOIN labels USING (doc_id)""")
def null_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return pr.null_counts(docs.join(table(spark, sf_dir, "labels"), "doc_id", "left"))


@query("A3", """SELECT event_type, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM events), 6)::DOUBLE AS pct
FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def frequency_table(spark, sf_dir):
    return round_doubles(pr.frequencies(table(spark, sf_dir, "events"), "event_type", 10))


@query("A4", """SELECT o_orderpriority, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM orders), 6)::DOUBLE AS pct
FROM orders GROUP BY 1""")
def class_distribution(spark, sf_dir):
    return round_doubles(pr.class_distribution(table(spark, sf_dir, "orders"), "o_orderpriority"))


@query("A5", WE + """SELECT split, count(*) AS total, count(*) FILTER (sus = 0 AND evil = 0) AS normal, count(*) FILTER (sus = 1) AS suspicious,
count(*) FILTER (evil = 1) AS malicious, round(100.0::DOUBLE * count(*) FILTER (sus = 0 AND evil = 0) / count(*), 6) AS normal_pct,
round(100.0::DOUBLE * count(*) FILTER (sus = 1) / count(*), 6) AS suspicious_pct,
round(100.0::DOUBLE * count(*) FILTER (evil = 1) / count(*), 6) AS malicious_pct FROM syscalls GROUP BY split""")
def three_way_counts(spark, sf_dir):
    return round_doubles(pr.three_way_counts(syscall_view(spark, sf_dir)))


@query("A6", """SELECT source, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM documents), 6)::DOUBLE AS pct
FROM documents GROUP BY 1 HAVING 100.0 * count(*) / (SELECT count(*) FROM documents) < 30""")
def minority_classes(spark, sf_dir):
    return round_doubles(pr.minority_classes(table(spark, sf_dir, "documents"), "source", 30.0))


@query("A7", WF + ", p AS (" + _union("""SELECT '@' AS column, count(@) AS count, avg(@) AS mean, stddev_samp(@) AS std, min(@) AS min,
max(@) AS max, var_samp(@) AS variance, count(*) FILTER (@ IS NULL) AS null_count, 100.0 * count(*) FILTER (@ IS NULL) / count(*) AS null_pct,
quantile_cont(@, 0.25) AS p25, quantile_cont(@, 0.5) AS p50, quantile_cont(@, 0.75) AS p75 FROM flows""") +
") SELECT \"column\", count, null_count, " + ", ".join(f"round({c}::DOUBLE, 4) AS {c}" for c in
    ("mean", "std", "min", "max", "null_pct", "p25", "p50", "p75")) + ", round(variance, 0) AS variance FROM p")
def column_profile(spark, sf_dir):
    out = pr.column_profile(_flow(spark, sf_dir), NUMS)
    return round_doubles(out.withColumn("variance", F.round("variance", 0)), 4)


@query("A8", """WITH d AS (SELECT user_id, event_type, CAST(floor(value) AS BIGINT) AS whole FROM events)
SELECT 'events' AS dataset, count(*) AS rows, CAST(3 AS BIGINT) AS columns,
count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS duplicates, CAST(0 AS BIGINT) AS null_cells,
round(sum(16 + strlen(event_type)) / 1048576.0::DOUBLE, 9) AS memory_mb FROM d""")
def data_quality(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", F.floor("value").alias("whole"))
    return round_doubles(pr.data_quality(events, "events"), 9)


@query("A9", WE + " " + _union("SELECT '@' AS column, count(DISTINCT @) AS distinct FROM syscalls",
                               ["processId", "userId", "hostName", "returnValue"]))
def distinct_values(spark, sf_dir):
    return pr.distinct_counts(syscall_view(spark, sf_dir), ["processId", "userId", "hostName", "returnValue"])


@query("A10", WF + "SELECT \"column\", round(variance, 0) AS variance FROM (" + _union("SELECT '@' AS column, var_samp(@) AS variance FROM flows")
       + ") ORDER BY variance DESC, 1 LIMIT 3")
def top_variance_columns(spark, sf_dir):
    return round_doubles(pr.top_by_variance(_flow(spark, sf_dir), 3, NUMS), 0)


@query("A11", WF + _union("SELECT '@' AS column, round(corr(@, label), 9) AS correlation FROM flows"))
def target_correlations(spark, sf_dir):
    return round_doubles(pr.target_correlations(_flow(spark, sf_dir), "label", NUMS), 9)


@query("A12", WF + " UNION ALL ".join(
    f"SELECT '{a}' AS left, '{b}' AS right, round(corr({a}, {b}), 7) AS correlation FROM flows" for a in NUMS for b in NUMS))
def correlation_matrix(spark, sf_dir):
    return round_doubles(pr.correlation_matrix(_flow(spark, sf_dir), NUMS), 7)


@query("A13", WE + """, e AS (SELECT min(value) AS lo, (max(value) - min(value)) / 50 AS w FROM syscalls),
b AS (SELECT sus, CAST(least(floor((value - lo) / w), 49) AS INTEGER) AS bin, count(*) AS n FROM syscalls, e GROUP BY 1, 2)
SELECT sus, bin, round(lo + bin * w, 6) AS low, round(lo + (bin + 1) * w, 6) AS high, n AS count,
round(n / (sum(n) OVER (PARTITION BY sus) * w), 6) AS density FROM b, e""")
def class_histogram(spark, sf_dir):
    return round_doubles(pr.histogram(syscall_view(spark, sf_dir), "value", 50, ["sus"]))


@query("A14", WE + """, q AS (SELECT sus, min(value) AS min, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
quantile_cont(value, 0.75) AS q3, max(value) AS max FROM syscalls GROUP BY sus),
w AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low_whisker, q3 + 1.5 * (q3 - q1) AS high_whisker FROM q)
SELECT w.sus, round(min, 6) AS min, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(max, 6) AS max,
round(low_whisker, 6) AS low_whisker, round(high_whisker, 6) AS high_whisker,
(SELECT count(*) FROM syscalls s WHERE s.sus = w.sus AND (value < low_whisker OR value > high_whisker)) AS outside FROM w""")
def box_summary(spark, sf_dir):
    return round_doubles(pr.box_summary(syscall_view(spark, sf_dir), "value", ["sus"]))


@query("A15", WF + _union("SELECT '@' AS column, round(avg(@), 4) AS mean, round(quantile_cont(@, 0.5), 4) AS median FROM flows"))
def mean_and_median(spark, sf_dir):
    return round_doubles(pr.mean_and_median(_flow(spark, sf_dir), NUMS), 4)


_OUT = """SELECT '@' AS column, label, count(*) AS rows, count(*) FILTER (abs(@ - m) / s > 2.5) AS outliers,
round(100.0::DOUBLE * count(*) FILTER (abs(@ - m) / s > 2.5) / count(*), 6) AS outlier_pct FROM flows, """


@query("A16", WF + _union(_OUT + "(SELECT avg(@) AS m, stddev_pop(@) AS s FROM flows) GROUP BY label"))
def global_outliers(spark, sf_dir):
    return round_doubles(pr.zscore_outliers(_flow(spark, sf_dir), NUMS, "label", 2.5))


@query("A17", WF + _union(_OUT + "(SELECT label AS l, avg(@) AS m, stddev_pop(@) AS s FROM flows GROUP BY 1) WHERE label = l GROUP BY label"))
def class_outliers(spark, sf_dir):
    return round_doubles(pr.zscore_outliers(_flow(spark, sf_dir), NUMS, "label", 2.5, within_class=True))


@query("A18", WF + """SELECT CAST(6 AS BIGINT) AS columns_before, CAST(6 AS BIGINT) AS columns_after, 'dbytes,sbytes,sjit,spkts,dload' AS x,
(SELECT count(*) FROM flows) AS rows_before, count(*) AS rows_after, (SELECT count(*) FROM flows) - count(*) AS rows_removed
FROM flows WHERE dload > 0""".replace("'dbytes,sbytes,sjit,spkts,dload' AS x",
    "'dbytes,dload,sbytes,sjit,spkts' AS dropped_columns, 'log_dbytes,log_dload,log_sbytes,log_sjit,log_spkts' AS new_columns"))
def schema_change(spark, sf_dir):
    before = _flow(spark, sf_dir)
    after = log_flows(drop_incomplete_rows(before).filter(F.col("dload") > 0))
    return pr.schema_change(before, after)


@query("A20", WE + """SELECT split, sus, count(*) AS rows, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean,
round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.9), 6) AS p90, max(value) AS p100 FROM syscalls GROUP BY 1, 2""")
def score_summary(spark, sf_dir):
    return round_doubles(pr.score_summary(syscall_view(spark, sf_dir), "value", ["split", "sus"]))


@query("R5", f"WITH {FLOW_SQL}, {SYSCALL_SQL}" + """ SELECT 'flows' AS dataset, count(*) AS rows, CAST(28 AS BIGINT) AS columns,
round(100.0::DOUBLE * sum(label) / count(*), 6) AS positive_pct FROM flows
UNION ALL SELECT 'syscalls', count(*), CAST(19 AS BIGINT), round(100.0::DOUBLE * sum(sus) / count(*), 6) FROM syscalls""")
def dataset_comparison(spark, sf_dir):
    parts = []
    for name, view, label in (("flows", flow_view, "label"), ("syscalls", syscall_view, "sus")):
        df = view(spark, sf_dir)
        parts.append(df.agg(
            F.lit(name).alias("dataset"), F.count("*").alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"),
            (100.0 * F.sum(label) / F.count("*")).alias("positive_pct")))
    return round_doubles(parts[0].unionByName(parts[1]))
