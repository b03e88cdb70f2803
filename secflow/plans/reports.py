"""Comparison reports over results that are themselves computed from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from secflow.functions.columns import round_doubles
from secflow.operators import evaluation, hypothesis, profiling, reports
from secflow.operators import tuning as tu
from secflow.operators.flow_features import engineer_flows
from secflow.plans.registry import query
from secflow.sources.views import FLOW_SQL, SYSCALL_SQL, flow_view, syscall_view

WF = f"WITH {FLOW_SQL} "
CUTS = [10.0, 20.0, 40.0, 60.0, 80.0, 95.0]
_SWEEP = f"WITH {SYSCALL_SQL}" + """, l AS (SELECT 'value' AS model, sus, value AS s FROM syscalls UNION ALL SELECT 'k', sus, CAST(k AS DOUBLE) FROM syscalls),
c AS (SELECT model, t AS threshold, count(*) FILTER (sus = 1 AND s > t) AS tp, count(*) FILTER (sus = 0 AND s > t) AS fp,
count(*) FILTER (sus = 1 AND s <= t) AS fn, count(*) FILTER (sus = 0 AND s <= t) AS tn FROM l, (SELECT unnest([""" + ", ".join(f"{c}::DOUBLE" for c in CUTS) + """]) AS t) GROUP BY 1, 2),
sweep AS (SELECT model, threshold, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
coalesce(tp / nullif(tp + fn, 0), 0) AS recall FROM c) """


def _sweep(spark, sf_dir):
    """f1, accuracy and recall of two scores at fixed thresholds."""
    entries = F.array(
        F.struct(F.lit("value").alias("model"), F.col("value").alias("s")),
        F.struct(F.lit("k").alias("model"), F.col("k").cast("double").alias("s")))
    long = syscall_view(spark, sf_dir).select("sus", F.explode(entries).alias("e")).select("sus", "e.*")
    grid = long.select("model").distinct().withColumn("thresholds", F.array(*[F.lit(c) for c in CUTS]))
    return evaluation.sweep(long, "s", "sus", grid, ["model"]).select("model", "threshold", "f1", "accuracy", "recall")


@query("G8", _SWEEP + """SELECT threshold, round(max(f1) FILTER (model = 'k'), 6) AS k, round(max(f1) FILTER (model = 'value'), 6) AS value
FROM sweep GROUP BY threshold""")
def sweep_pivot(spark, sf_dir):
    return round_doubles(tu.pivot_results(_sweep(spark, sf_dir), "threshold", "model", "f1", ["k", "value"]))


@query("G9", _SWEEP + """SELECT model, threshold, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy, round(recall, 6) AS recall FROM
(SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold) AS r FROM sweep) WHERE r = 1""")
def best_configurations(spark, sf_dir):
    return round_doubles(tu.best_configuration(_sweep(spark, sf_dir), "f1", ["model"], ["threshold"]))


@query("G12", _SWEEP + """, b AS (SELECT * FROM sweep WHERE threshold = 80), t AS (SELECT * FROM
(SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold) AS r FROM sweep) WHERE r = 1),
j AS (SELECT b.model, 'f1' AS metric, b.f1 AS x, t.f1 AS y FROM b JOIN t USING (model) UNION ALL SELECT b.model, 'accuracy', b.accuracy, t.accuracy FROM b JOIN t USING (model))
SELECT model, metric, round(x, 6) AS baseline, round(y, 6) AS tuned, round(y - x, 6) AS delta, round(100 * (y - x) / nullif(x, 0), 6) AS pct FROM j""")
def baseline_versus_tuned(spark, sf_dir):
    sweep = _sweep(spark, sf_dir)
    best = tu.best_configuration(sweep, "f1", ["model"], ["threshold"])
    return round_doubles(tu.baseline_versus_tuned(sweep.filter("threshold = 80"), best, ["f1", "accuracy"]))


@query("R3", _SWEEP + "SELECT model, round(max(f1) - min(f1), 6) AS range, round(max(f1), 6) AS best FROM sweep GROUP BY model")
def metric_range(spark, sf_dir):
    return round_doubles(reports.metric_range(_sweep(spark, sf_dir), "f1", ["model"]))


NAMES = {"sbytes": "sbytes", "dload": "dload", "sttl": "sttl", "sum_sbytes_dbytes": "sbytes + dbytes",
         "diff_sbytes_dbytes": "sbytes - dbytes", "distance_sbytes_dbytes": "abs(sbytes - dbytes) / (sbytes + dbytes + 0.000001::DOUBLE)"}
_LISTS = WF + ", x AS (SELECT label, " + ", ".join(f"{e} AS {c}" for c, e in NAMES.items()) + " FROM flows), c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS f, abs(corr({c}, label)) AS r, var_samp({c}) / (avg(abs({c})) ** 2) AS v FROM x" for c in NAMES) + """),
a AS (SELECT f FROM c ORDER BY r DESC, f LIMIT 4), b AS (SELECT f FROM c ORDER BY v DESC, f LIMIT 4), both_ AS (SELECT f AS feature FROM a INTERSECT SELECT f FROM b) """
_ENG = "regexp_matches(feature, '^(log_)?(sum|diff|ratio|both_zero|one_zero|is_integer_ratio|distance)_|^log_distance_')"


def _lists(spark, sf_dir):
    df = engineer_flows(flow_view(spark, sf_dir).select("label", "sbytes", "dbytes", "dload", "sttl"), {"sbytes": "dbytes"})
    names = list(NAMES)
    by_target = profiling.target_correlations(df, "label", names).withColumn("r", F.abs("correlation"))
    spread = df.agg(*[(F.var_samp(c) / F.pow(F.avg(F.abs(c)), F.lit(2))).alias(c) for c in names]).unpivot([], names, "column", "v")
    return reports.top_k(by_target, "column", "r", 4), reports.top_k(spread, "column", "v", 4)


@query("R1", _LISTS + f"SELECT feature, CASE WHEN {_ENG} THEN 1 ELSE 0 END AS engineered FROM both_")
def agreed_features(spark, sf_dir):
    return reports.agreed_features(*_lists(spark, sf_dir))


@query("R1", _LISTS + f"""SELECT count(*) AS features, count(*) FILTER ({_ENG}) AS engineered, round(100.0::DOUBLE * count(*) FILTER ({_ENG}) / count(*), 6) AS engineered_pct
FROM (SELECT f AS feature FROM a UNION SELECT f FROM b)""")
def engineered_share(spark, sf_dir):
    left, right = _lists(spark, sf_dir)
    return round_doubles(reports.engineered_share(left.union(right).distinct()))


_KINDS = ["sbytes", "dbytes", "spkts", "dload", "sttl"]
_SETS = WF + ", s AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS f, (sum(n * (m - g) ** 2) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS score
FROM (SELECT count(*) AS n, avg({c}) AS m, var_pop({c}) AS v FROM flows GROUP BY label), (SELECT avg({c}) AS g FROM flows)""" for c in _KINDS) + """),
r AS (SELECT 'all' AS k, count(*) AS w, avg(score) AS m FROM s UNION ALL SELECT 'selected', count(*), avg(score) FROM (SELECT * FROM s ORDER BY score DESC, f LIMIT 2)) """


@query("R2 X11", _SETS + """SELECT round(100 * (1 - (SELECT w FROM r WHERE k = 'selected') / (SELECT w FROM r WHERE k = 'all')), 6) AS reduction_pct,
round((SELECT m FROM r WHERE k = 'selected') - (SELECT m FROM r WHERE k = 'all'), 6) AS mean_f_delta""")
def feature_reduction(spark, sf_dir):
    """Width saved and mean F score gained by keeping the two best columns."""
    scores = hypothesis.anova(flow_view(spark, sf_dir).select("label", *_KINDS), _KINDS, "label").select("column", "score")
    best = scores.orderBy(F.desc("score"), "column").limit(2)
    sets = [d.agg(F.lit(n).alias("kind"), F.count("*").alias("width"), F.avg("score").alias("mean_f")) for n, d in (("all", scores), ("selected", best))]
    return round_doubles(reports.reduction(reports.union_all(sets), "kind", "width", "mean_f"))


@query("R4", _SWEEP + """SELECT round(max(f1), 6) AS best_f1, (SELECT model FROM sweep ORDER BY f1 DESC, model LIMIT 1) AS best_model,
round((SELECT max(accuracy) FROM sweep), 6) AS best_accuracy, (SELECT count(*) FROM syscalls) AS rows FROM sweep""")
def summary_row(spark, sf_dir):
    sweep = _sweep(spark, sf_dir)
    return round_doubles(reports.summary_row({
        "best_f1": sweep.agg(F.max("f1").alias("v")),
        "best_model": sweep.orderBy(F.desc("f1"), "model").limit(1).select("model"),
        "best_accuracy": sweep.agg(F.max("accuracy").alias("v")),
        "rows": syscall_view(spark, sf_dir).agg(F.count("*").alias("v")),
    }))
