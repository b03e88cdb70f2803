"""Evaluation queries over given labels, scores and predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from secflow.functions.columns import round_doubles
from secflow.operators import evaluation as ev
from secflow.plans.registry import query
from secflow.sources.views import (
    CLASSES_SQL, SCORES_SQL, SYSCALL_SQL, class_view, score_view, syscall_view,
)

S = f"WITH {SCORES_SQL} "
C = f"WITH {CLASSES_SQL} "
E = f"WITH {SYSCALL_SQL} "
RATES = """round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1"""
FPR = "round(coalesce(fp / nullif(fp + tn, 0), 0), 6) AS fpr, round(coalesce(tn / nullif(fp + tn, 0), 0), 6) AS tnr"
COUNTS = """count(*) FILTER (label = 1 AND flag = 1) AS tp, count(*) FILTER (label = 0 AND flag = 1) AS fp,
count(*) FILTER (label = 0 AND flag = 0) AS tn, count(*) FILTER (label = 1 AND flag = 0) AS fn"""
REPORT = """, truth AS (SELECT actual AS class, count(*) AS support FROM classes GROUP BY 1),
guess AS (SELECT predicted AS class, count(*) AS guesses FROM classes GROUP BY 1),
hit AS (SELECT actual AS class, count(*) AS hits FROM classes WHERE actual = predicted GROUP BY 1),
report AS (SELECT class, coalesce(coalesce(hits, 0) / nullif(guesses, 0), 0) AS p,
  coalesce(coalesce(hits, 0) / nullif(support, 0), 0) AS r, coalesce(support, 0) AS support
  FROM truth FULL JOIN guess USING (class) LEFT JOIN hit USING (class)),
scored AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM report) """
ROC = """, g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scores GROUP BY score),
c AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(neg) OVER (ORDER BY score DESC) AS cn,
  sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g) """


@query("E1", C + REPORT + """SELECT round((SELECT avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END) FROM classes), 6) AS accuracy,
round(sum(p * support) / sum(support), 6) AS precision, round(sum(r * support) / sum(support), 6) AS recall,
round(sum(f * support) / sum(support), 6) AS f1, (SELECT count(DISTINCT actual) FROM classes) AS classes FROM scored""")
def weighted_classification_metrics(spark, sf_dir):
    return round_doubles(ev.classification_metrics(class_view(spark, sf_dir), "actual", "predicted"))


@query("E1 M9", S + f", m AS (SELECT {COUNTS} FROM (SELECT label, CASE WHEN score > 2000 THEN 1 ELSE 0 END AS flag FROM scores)) "
       f"SELECT {RATES}, (SELECT count(DISTINCT label) FROM scores) AS classes FROM m")
def binary_classification_metrics(spark, sf_dir):
    flagged = score_view(spark, sf_dir).withColumn("flag", (F.col("score") > 2000).cast("int"))
    return round_doubles(ev.classification_metrics(flagged, "label", "flag", positive=1))


@query("E2", C + """, names AS (SELECT actual AS c FROM classes UNION SELECT predicted FROM classes),
n AS (SELECT actual, predicted, count(*) AS n FROM classes GROUP BY 1, 2)
SELECT a.c AS actual, b.c AS predicted, coalesce(n, 0) AS value FROM names a CROSS JOIN names b
LEFT JOIN n ON n.actual = a.c AND n.predicted = b.c""")
def confusion_matrix_counts(spark, sf_dir):
    return ev.confusion_matrix(class_view(spark, sf_dir), "actual", "predicted")


@query("E2", C + """, names AS (SELECT actual AS c FROM classes UNION SELECT predicted FROM classes),
n AS (SELECT actual, predicted, count(*) AS n FROM classes GROUP BY 1, 2)
SELECT a.c AS actual, b.c AS predicted, round(coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY a.c), 6) AS value
FROM names a CROSS JOIN names b LEFT JOIN n ON n.actual = a.c AND n.predicted = b.c""")
def confusion_matrix_shares(spark, sf_dir):
    return round_doubles(ev.confusion_matrix(class_view(spark, sf_dir), "actual", "predicted", normalize=True))


@query("E3", C + REPORT + "SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM scored")
def class_report(spark, sf_dir):
    return round_doubles(ev.class_report(class_view(spark, sf_dir), "actual", "predicted"))


@query("E3 W8", C + REPORT + """SELECT round(avg(p), 6) AS macro_precision, round(sum(p * support) / sum(support), 6) AS weighted_precision,
round(avg(r), 6) AS macro_recall, round(sum(r * support) / sum(support), 6) AS weighted_recall,
round(avg(f), 6) AS macro_f1, round(sum(f * support) / sum(support), 6) AS weighted_f1,
CAST(sum(support) AS BIGINT) AS support, count(*) AS classes FROM scored""")
def class_report_averages(spark, sf_dir):
    return round_doubles(ev.average_report(ev.class_report(class_view(spark, sf_dir), "actual", "predicted")))


@query("E4", S + ROC + "SELECT score AS threshold, round(cp / p, 9) AS tpr, round(cn / n, 9) AS fpr FROM c")
def roc_curve(spark, sf_dir):
    return round_doubles(ev.roc_curve(score_view(spark, sf_dir), "score", "label"), 9)


@query("E4", S + """, pairs AS (SELECT sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END)::DOUBLE AS wins,
count(*) AS n FROM scores a, scores b WHERE a.label = 1 AND b.label = 0)
SELECT round(wins / n, 9) AS auc, (SELECT count(*) FROM scores WHERE label = 1) AS positives FROM pairs""")
def roc_area(spark, sf_dir):
    """The twin counts (positive, negative) pairs: the definition of the area."""
    return round_doubles(ev.roc_auc(score_view(spark, sf_dir), "score", "label"), 9)


@query("E5", S + ROC + "SELECT score AS threshold, round(cp / (cp + cn), 9) AS precision, round(cp / p, 9) AS recall FROM c")
def precision_recall_curve(spark, sf_dir):
    return round_doubles(ev.pr_curve(score_view(spark, sf_dir), "score", "label"), 9)


@query("E5", S + ROC + "SELECT round(sum(pos / p * (cp / (cp + cn))), 9) AS average_precision FROM c")
def average_precision(spark, sf_dir):
    return round_doubles(ev.average_precision(score_view(spark, sf_dir), "score", "label"), 9)


@query("E6", """WITH s AS (SELECT o_orderpriority AS actual, c.name AS class,
  (o_orderkey * (c.i + 3) % 101) + CASE WHEN o_orderpriority = c.name THEN 20 ELSE 0 END AS score
  FROM orders, (SELECT row_number() OVER (ORDER BY o_orderpriority) AS i, o_orderpriority AS name
    FROM (SELECT DISTINCT o_orderpriority FROM orders)) c),
g AS (SELECT class, score, count(*) FILTER (actual = class) AS pos, count(*) FILTER (actual <> class) AS neg FROM s GROUP BY 1, 2),
w AS (SELECT class, pos, neg, sum(pos) OVER (PARTITION BY class ORDER BY score DESC) AS cp FROM g),
a AS (SELECT class, sum(neg * (cp - pos / 2)) / (sum(pos) * sum(neg)) AS auc, sum(pos) AS p FROM w GROUP BY 1)
SELECT round(sum(auc * p) / sum(p), 9) AS auc, count(*) AS classes FROM a""")
def multiclass_roc_area(spark, sf_dir):
    """One score per class and row, in long form; only (class, score) counts are ranked."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderpriority")
    names = orders.select("o_orderpriority").distinct().agg(F.array_sort(F.collect_set("o_orderpriority")).alias("names"))
    long = orders.withColumn("names", names.scalar()).select(
        "o_orderkey", F.col("o_orderpriority").alias("actual"), F.posexplode("names").alias("i", "class")
    )
    bonus = F.when(F.col("actual") == F.col("class"), 20).otherwise(0)
    scored = long.withColumn("score", F.col("o_orderkey") * (F.col("i") + 4) % 101 + bonus)
    return round_doubles(ev.multiclass_auc(scored, "actual", "class", "score"), 9)


@query("E7", E + f", m AS (SELECT {COUNTS} FROM (SELECT sus AS label, CASE WHEN value > 20 THEN 1 ELSE 0 END AS flag FROM syscalls)) "
       f"SELECT tp, fp, tn, fn, {RATES}, {FPR} FROM m")
def anomaly_metrics(spark, sf_dir):
    flagged = syscall_view(spark, sf_dir).withColumn("flag", (F.col("value") > 20).cast("int"))
    return round_doubles(ev.anomaly_metrics(flagged, "sus", "flag"))


def _best(grid: str, extra: str = "", cols: str = "threshold") -> str:
    return f""", grid AS ({grid}), m AS (SELECT step, threshold, count(*) FILTER (label = 1 AND score > threshold) AS tp,
    count(*) FILTER (label = 0 AND score > threshold) AS fp, count(*) FILTER (label = 0 AND score <= threshold) AS tn,
    count(*) FILTER (label = 1 AND score <= threshold) AS fn FROM scores, grid GROUP BY 1, 2),
    k AS (SELECT * FROM m {extra}) """


_PCT_GRID = """SELECT unnest(range(100)) AS step, unnest((SELECT quantile_cont(score, [""" + ", ".join(
    f"{i}/99.0::DOUBLE" for i in range(100)) + """]) FROM scores)) AS threshold"""


def _line_grid(lo: float, hi: float, n: int) -> str:
    return (f"SELECT i AS step, lo + i * ((hi - lo) / {n - 1}) AS threshold FROM (SELECT quantile_cont(score, {lo}) AS lo, "
            f"quantile_cont(score, {hi}) AS hi FROM scores), range({n}) t(i)")


_TWO = "WHERE tp + fp > 0 AND tn + fn > 0"
_PICK = f"SELECT round(threshold, 6) AS threshold, {RATES} FROM k ORDER BY coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) DESC, step LIMIT 1"


@query("E8 J8", S + _best(_PCT_GRID) + _PICK)
def best_percentile_threshold(spark, sf_dir):
    return round_doubles(ev.best_percentile_threshold(score_view(spark, sf_dir), "score", "label", "f1"))


@query("E9 J8", S + _best(_line_grid(0.5, 1.0, 100), _TWO) + _PICK)
def best_linear_threshold(spark, sf_dir):
    return round_doubles(ev.best_linear_threshold(score_view(spark, sf_dir), "score", "label", "f1", 0.5, 1.0))


@query("E10 J8", S + _best(_line_grid(0.01, 0.99, 200), _TWO)
       + f"SELECT CAST(step AS INTEGER) AS step, round(threshold, 6) AS threshold, tp, fp, tn, fn, {RATES}, {FPR} FROM k")
def threshold_table(spark, sf_dir):
    return round_doubles(ev.threshold_table(score_view(spark, sf_dir), "score", "label"))


@query("E11", S + ROC + """SELECT score AS threshold, round(cp / p, 9) AS tpr, round(cn / n, 9) AS fpr, round(cp / p - cn / n, 9) AS j
FROM c ORDER BY cp / p - cn / n DESC, score DESC LIMIT 1""")
def youden_threshold(spark, sf_dir):
    return round_doubles(ev.youden_point(score_view(spark, sf_dir), "score", "label"), 9)


_TARGETS = E + """, long AS (SELECT m.model, t.target, CASE t.target WHEN 'sus' THEN sus ELSE evil END AS label,
  CASE m.model WHEN 'value' THEN CASE WHEN value > 20 THEN 1 ELSE 0 END ELSE CASE WHEN k > 90 THEN 1 ELSE 0 END END AS flag
  FROM syscalls, (VALUES ('value'), ('k')) m(model), (VALUES ('sus'), ('evil')) t(target)) """


def _flagged(spark, sf_dir):
    return syscall_view(spark, sf_dir).withColumns(
        {"value_flag": (F.col("value") > 20).cast("int"), "k_flag": (F.col("k") > 90).cast("int")}
    )


@query("E14", _TARGETS + f", m AS (SELECT model, target, {COUNTS} FROM long GROUP BY 1, 2) SELECT model, target, tp, fp, tn, fn, {RATES}, {FPR} FROM m")
def metrics_by_model_and_target(spark, sf_dir):
    return round_doubles(ev.metrics_by_target(_flagged(spark, sf_dir), ["value", "k"], ["sus", "evil"]))


@query("E12 E13", _TARGETS + f", m AS (SELECT model, {COUNTS} FROM long WHERE target = 'sus' GROUP BY 1) SELECT model, tp, fp, tn, fn, {RATES}, {FPR} FROM m")
def evaluation_report(spark, sf_dir):
    return round_doubles(ev.evaluation_report(_flagged(spark, sf_dir), ["value", "k"], "sus"))


@query("E12 E15", _TARGETS + f""", m AS (SELECT CASE model WHEN 'value' THEN 'baseline' ELSE 'enhanced' END AS model, {COUNTS}
  FROM long WHERE target = 'evil' GROUP BY 1) SELECT model, tp, fp, tn, fn, {RATES}, {FPR} FROM m""")
def feature_set_comparison(spark, sf_dir):
    """Baseline against enhanced scores on the same rows."""
    flagged = _flagged(spark, sf_dir)
    return round_doubles(ev.compare_models([
        ("baseline", ev.anomaly_metrics(flagged, "evil", "value_flag")),
        ("enhanced", ev.anomaly_metrics(flagged, "evil", "k_flag")),
    ]))


@query("E16", S + _best(_line_grid(0.5, 1.0, 100), _TWO) + """, best AS (SELECT threshold AS t FROM k
  ORDER BY coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) DESC, step LIMIT 1),
q AS (SELECT quantile_cont(score, 0.5) AS lo, quantile_cont(score, 1.0) AS hi,
  quantile_cont(CASE WHEN label = 0 THEN score END, 0.5) AS m0, quantile_cont(CASE WHEN label = 1 THEN score END, 0.5) AS m1 FROM scores)
SELECT round(t, 6) AS threshold, round(100 * (t - lo) / nullif(hi - lo, 0), 6) AS position_pct,
round(abs(t - m0), 6) AS gap_to_normal, round(abs(t - m1), 6) AS gap_to_anomaly FROM best, q""")
def threshold_placement(spark, sf_dir):
    scores = score_view(spark, sf_dir)
    best = ev.best_linear_threshold(scores, "score", "label", "f1", 0.5, 1.0)
    return round_doubles(ev.threshold_placement(scores, "score", "label", best, 0.5, 1.0))
