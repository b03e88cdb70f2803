"""Model fits, two-stage classification and searches on the flow, score and vector views."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from secflow.functions.columns import round_doubles
from secflow.operators import boosting, cleaning, evaluation, splitting, tree_search, two_stage
from secflow.operators import supervised as su
from secflow.operators import tuning as tu
from secflow.plans.registry import query
from secflow.session import cut_lineage
from secflow.sources.views import CLASSES_SQL, FLOW_SQL, SCORES_SQL, class_view, flow_view, score_view, vector_view

WF = f"WITH {FLOW_SQL} "
NUMS = ["sbytes", "dbytes", "spkts", "dload", "sttl"]
TEXTS = ["service", "state"]
COLS = {"numeric": NUMS, "text": TEXTS}


def _flow(spark, sf_dir):
    """Flows with a binary label that the features carry in part."""
    flows = flow_view(spark, sf_dir).select("row_id", "attack_cat", *NUMS, *TEXTS, "dpkts")
    busy = (F.col("sbytes") * F.col("dpkts") > F.col("dbytes")) & (F.col("state") != "P")
    return flows.withColumn("label", busy.cast("int")).drop("dpkts")


def _halves(spark, sf_dir):
    df = splitting.stratified_split(_flow(spark, sf_dir), "label", 0.5, names=("train", "test")).persist()
    return df.filter("split = 'train'").drop("split"), df.filter("split = 'test'").drop("split")


@query("M1 M2 S5 S6")
def logistic_coefficients(spark, sf_dir):
    train, _ = _halves(spark, sf_dir)
    return su.LogisticClassifier(**COLS, most_rounds=50).fit(train).coefficients(spark)


@query("M1")
def logistic_metrics(spark, sf_dir):
    train, test = _halves(spark, sf_dir)
    model = su.LogisticClassifier(**COLS, penalty="elasticnet", most_rounds=50).fit(train)
    return su.compare_classifiers({"logistic_regression": model}, test)


@query("M3 M4")
def forest_importances(spark, sf_dir):
    train, _ = _halves(spark, sf_dir)
    return su.ForestClassifier(**COLS, trees=20, depth=8).fit(train).importances(spark)


@query("M4")
def forest_depths(spark, sf_dir):
    train, _ = _halves(spark, sf_dir)
    return su.ForestClassifier(**COLS, trees=10, depth=8).fit(train).depths(spark)


@query("M5 M6 M7")
def boosted_importances(spark, sf_dir):
    """Mean gain per split; validation rows stop the boosting."""
    train, test = _halves(spark, sf_dir)
    return su.BoostedClassifier(**COLS, early_stop=True).fit(train, test).importances(spark, "gain")


@query("M5")
def boosted_attack_types(spark, sf_dir):
    """More than two classes by softmax, one tree per class and round."""
    train, test = _halves(spark, sf_dir)
    model = su.BoostedClassifier(**COLS, label="attack_cat", trees=10).fit(train)
    return evaluation.class_report(model.predict(test), "attack_cat", "prediction")


@query("M8 E12 S11")
def standard_classifiers(spark, sf_dir):
    train, test = _halves(spark, sf_dir)
    models = su.train_standard(train, logistic_regression={**COLS, "most_rounds": 30}, random_forest={**COLS, "trees": 20, "depth": 8},
                               boosted_trees={**COLS, "trees": 10, "depth": 4})
    return su.compare_classifiers(models, test)


@query("S11")
def prediction_table(spark, sf_dir):
    train, test = _halves(spark, sf_dir)
    return su.prediction_table({"lr": su.LogisticClassifier(**COLS, most_rounds=20).fit(train)}, test)


@query("M9", f"WITH {SCORES_SQL}" + """, p AS (SELECT label, score / (SELECT max(score) FROM scores) AS p FROM scores),
l AS (SELECT t.cutoff, label, CASE WHEN p >= t.cutoff THEN 1 ELSE 0 END AS flag FROM p, (VALUES (0.05::DOUBLE), (0.5::DOUBLE)) t(cutoff)),
m AS (SELECT cutoff, count(*) FILTER (label = 1 AND flag = 1) AS tp, count(*) FILTER (label = 0 AND flag = 1) AS fp,
count(*) FILTER (label = 0 AND flag = 0) AS tn, count(*) FILTER (label = 1 AND flag = 0) AS fn FROM l GROUP BY 1)
SELECT cutoff, tp, fp, tn, fn, round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
round(coalesce(fp / nullif(fp + tn, 0), 0), 6) AS fpr, round(coalesce(tn / nullif(fp + tn, 0), 0), 6) AS tnr FROM m""")
def probability_cutoffs(spark, sf_dir):
    """A low probability cut-off against the usual one."""
    scores = score_view(spark, sf_dir)
    share = scores.withColumn("_top", scores.agg(F.max("score").alias("m")).scalar()).withColumn("p", F.col("score") / F.col("_top"))
    cuts = F.array(*[F.struct(F.lit(c).alias("cutoff"), (F.col("p") >= c).cast("int").alias("flag")) for c in (0.05, 0.5)])
    long = share.select("label", F.explode(cuts).alias("c")).select("label", "c.*")
    return round_doubles(evaluation.anomaly_metrics(long, "label", "flag", ["cutoff"]))


@query("W4 J3", WF + """SELECT attack_cat, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 9) AS weight FROM flows GROUP BY attack_cat""")
def class_weights(spark, sf_dir):
    return round_doubles(su.class_weights(flow_view(spark, sf_dir), "attack_cat"), 9)


_RESULT = f"WITH {CLASSES_SQL}" + """, two AS (SELECT row_id, CASE WHEN row_id % 3 = 0 THEN 'Normal' ELSE actual END AS truth,
CASE WHEN row_id % 5 < 3 THEN predicted ELSE 'Normal' END AS final FROM classes) """


def _stages(spark, sf_dir):
    """Given predictions of both stages for every order."""
    rows = class_view(spark, sf_dir).withColumn("label", (F.col("row_id") % 3 != 0).cast("int")).withColumn(
        "attack_cat", F.col("actual")).withColumn("true_class", cleaning.true_class())
    found = two_stage.detected(rows.withColumn("prediction", (F.col("row_id") % 5 < 3).cast("int")))
    return rows, found


@query("W1 W5 J2 C19", _RESULT + "SELECT row_id, truth AS true_class, final FROM two")
def two_stage_overlay(spark, sf_dir):
    rows, found = _stages(spark, sf_dir)
    return two_stage.combine(rows, found, named="predicted").select("row_id", "true_class", "final")


@query("W6 W8", _RESULT + """SELECT count(*) AS rows, count(*) FILTER (final = 'Normal' AND truth = 'Normal') AS true_normal,
count(*) FILTER (final <> 'Normal' AND truth = 'Normal') AS false_alarm, count(*) FILTER (final = 'Normal' AND truth <> 'Normal') AS missed,
count(*) FILTER (final <> 'Normal' AND final = truth) AS right_type,
count(*) FILTER (final <> 'Normal' AND truth <> 'Normal' AND final <> truth) AS wrong_type,
round(avg(CASE WHEN final = truth THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM two""")
def two_stage_outcomes(spark, sf_dir):
    rows, found = _stages(spark, sf_dir)
    return round_doubles(two_stage.outcome_counts(two_stage.combine(rows, found, named="predicted")))


@query("W2 W7 J7", f"WITH {CLASSES_SQL}" + """, d AS (SELECT * FROM classes WHERE row_id % 3 <> 0 AND row_id % 5 < 3),
t AS (SELECT actual AS class, count(*) AS support, count(*) FILTER (actual = predicted) AS hits FROM d GROUP BY 1),
g AS (SELECT predicted AS class, count(*) AS guesses FROM d GROUP BY 1),
r AS (SELECT class, coalesce(support, 0) AS support, coalesce(coalesce(hits, 0) / nullif(guesses, 0), 0) AS p, coalesce(coalesce(hits, 0) / nullif(support, 0), 0) AS r FROM t FULL JOIN g USING (class))
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1, support FROM r""")
def stage_two_report(spark, sf_dir):
    rows, found = _stages(spark, sf_dir)
    return round_doubles(two_stage.type_report(rows, found, "actual", "predicted"))


@query("W3", """WITH g AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1) SELECT label, (SELECT max(n) FROM g) AS rows, (SELECT max(n) FROM g) - n AS synthetic FROM g""")
def oversampled_classes(spark, sf_dir):
    """Every class brought to the size of the largest with points between near neighbours."""
    made = two_stage.oversample(vector_view(spark, sf_dir), "label")
    return made.groupBy("label").agg(F.count("*").alias("rows"), F.sum("synthetic").alias("synthetic"))


@query("W1 W2 W4 W5 W6")
def two_stage_run(spark, sf_dir):
    train, test = _halves(spark, sf_dir)
    final = two_stage.run_two_stage(
        train, test, su.BoostedClassifier(**COLS),
        su.ForestClassifier(**COLS, label="attack_cat", least_leaf=2))
    return two_stage.outcome_counts(final.withColumn("true_class", cleaning.true_class()))


@query("G2")
def logistic_search(spark, sf_dir):
    return tu.tune_logistic(_flow(spark, sf_dir), **COLS)


@query("G3")
def forest_search(spark, sf_dir):
    return tu.tune_forest(_flow(spark, sf_dir), most_rows=tree_search.MOST_ROWS, **COLS)


@query("G4")
def boosted_search(spark, sf_dir):
    return tu.tune_boosted(_flow(spark, sf_dir), **COLS)


def _swept(spark, sf_dir, settings):
    train, test = _halves(spark, sf_dir)
    return tu.boosted_sweep(train, test, settings, **COLS)


@query("G10")
def boosted_depth_sweep(spark, sf_dir):
    """100 rounds at each depth, all models in the same passes."""
    return _swept(spark, sf_dir, [{"depth": d} for d in (3, 6, 9, 12)])


@query("G10")
def boosted_rate_sweep(spark, sf_dir):
    return _swept(spark, sf_dir, [{"rate": r} for r in (0.01, 0.05, 0.1, 0.2)])


@query("G10 M5")
def boosted_penalty_sweep(spark, sf_dir):
    """Leaf penalties: none, the usual one, and stronger ones of either kind."""
    return _swept(spark, sf_dir, [{"l1": 0.0, "l2": 0.0}, {"l1": 0.0, "l2": 1.0}, {"l1": 0.1, "l2": 1.0}, {"l1": 1.0, "l2": 1.0}, {"l1": 0.0, "l2": 5.0}])


_STUMP_CUTS = {"spkts": range(5, 50, 5), "sttl": range(16, 256, 16), "dpkts": range(1, 7)}
_STUMP_PENALTIES = [(0.0, 1.0), (50.0, 1.0), (0.0, 500.0), (50.0, 500.0)]


@query("M5 M6", WF + """, r AS (SELECT spkts, sttl, dpkts, CASE WHEN sbytes * dpkts > dbytes AND state <> 'P' THEN 1 ELSE 0 END AS y FROM flows),
x AS (SELECT 'spkts' AS feature, 0 AS f, spkts AS v, y FROM r UNION ALL SELECT 'sttl', 1, sttl, y FROM r UNION ALL SELECT 'dpkts', 2, dpkts, y FROM r),
c AS (SELECT 'spkts' AS feature, unnest(range(5, 50, 5)) AS cut UNION ALL SELECT 'sttl', unnest(range(16, 256, 16)) UNION ALL SELECT 'dpkts', unnest(range(1, 7))),
h AS (SELECT feature, f, cut, coalesce(sum(0.5 - y) FILTER (v <= cut), 0)::DOUBLE AS gl, 0.25::DOUBLE * count(*) FILTER (v <= cut) AS hl,
sum(0.5 - y)::DOUBLE AS g, 0.25::DOUBLE * count(*) AS h FROM x JOIN c USING (feature) GROUP BY ALL),
s (l1, l2) AS (VALUES (0::DOUBLE, 1::DOUBLE), (50, 1), (0, 500), (50, 500)),
t AS (SELECT *, greatest(abs(gl) - l1, 0) * sign(gl) AS tl, greatest(abs(g - gl) - l1, 0) * sign(g - gl) AS tr, greatest(abs(g) - l1, 0) * sign(g) AS ta FROM h, s),
p AS (SELECT *, (tl * tl / (hl + l2) + tr * tr / (h - hl + l2) - ta * ta / (h + l2)) / 2 AS gain, -0.1 * tl / (hl + l2) AS vl, -0.1 * tr / (h - hl + l2) AS vr FROM t WHERE hl >= 1 AND h - hl >= 1),
b AS (SELECT *, row_number() OVER (PARTITION BY l1, l2 ORDER BY gain DESC, f, cut) AS n FROM p)
SELECT l1, l2, feature, cut::DOUBLE AS threshold, round(gain, 4) AS gain, round(vl, 8) AS left_value, round(vr, 8) AS right_value,
round((4 * hl * ln(1 + exp(vl)) - (2 * hl - gl) * vl + 4 * (h - hl) * ln(1 + exp(vr)) - (2 * (h - hl) - (g - gl)) * vr) / (4 * h), 8) AS train_loss FROM b WHERE n = 1""")
def boosted_stump_penalties(spark, sf_dir):
    """First split, its gain, leaf values and training loss of one-split models, grown side by side under four penalties."""
    names = list(_STUMP_CUTS)
    busy = (F.col("sbytes") * F.col("dpkts") > F.col("dbytes")) & (F.col("state") != "P")
    rows = flow_view(spark, sf_dir).select(F.array(*names).alias("features"), busy.cast("int").alias("label"))
    settings = [boosting.Settings(trees=1, depth=1, l1=a, l2=b) for a, b in _STUMP_PENALTIES]
    found = boosting.fit_boosted(rows, settings, cuts=[np.array(c, float) for c in _STUMP_CUTS.values()])
    out = []
    for (l1, l2), m in zip(_STUMP_PENALTIES, found):
        (root, left, right), loss = m.node_rows()[:3], m.losses[-1][0]
        out.append((l1, l2, names[root[3]], root[4], root[5], left[7], right[7], loss))
    table = spark.createDataFrame(out, "l1 double, l2 double, feature string, threshold double, gain double, left_value double, right_value double, train_loss double")
    return table.select("l1", "l2", "feature", "threshold", F.round("gain", 4).alias("gain"),
                        *[F.round(c, 8).alias(c) for c in ("left_value", "right_value", "train_loss")])


@query("G3")
def forest_search_best(spark, sf_dir):
    """The best setting, searched and fitted on all training rows, with its area on rows the search has not seen."""
    train, test = _halves(spark, sf_dir)
    table = cut_lineage(tu.tune_forest(train, **COLS))
    _, setting, searched, seen = tu.best_model(table, su.ForestClassifier, train, test, **COLS)
    return spark.createDataFrame([(str(setting), searched, seen)], "params string, search_auc double, validation_auc double")


@query("G11 Z6")
def sample_then_refit(spark, sf_dir):
    """Settings chosen on a stratified sample, then a fit on all rows."""
    train, test = _halves(spark, sf_dir)
    sample = splitting.stratified_sample(train, "label", 10_000)
    best = tu.tune_logistic(sample, {"C": [0.1, 1.0]}, 2, **COLS, most_rounds=20).head()["params"]
    model = su.LogisticClassifier(**COLS, most_rounds=20, C=0.1 if "0.1" in best else 1.0).fit(train)
    return su.compare_classifiers({"refit": model}, test)


@query("G1 U14")
def elbow_curve(spark, sf_dir):
    return tu.elbow(vector_view(spark, sf_dir), [2, 4, 6])


@query("G1", """WITH b AS (SELECT k, least(floor(value * k / (SELECT max(value) FROM events)), k - 1) AS c, value FROM events, range(2, 9) t(k)),
v AS (SELECT k, sum(n * v) AS inertia FROM (SELECT k, c, count(*) AS n, var_pop(value) AS v FROM b GROUP BY 1, 2) GROUP BY 1),
d AS (SELECT k, lag(inertia) OVER (ORDER BY k) - 2 * inertia + lead(inertia) OVER (ORDER BY k) AS bend FROM v)
SELECT CAST(k AS INTEGER) AS k, round(bend, 1) AS bend FROM d WHERE bend IS NOT NULL ORDER BY bend DESC, k LIMIT 1""")
def elbow_pick(spark, sf_dir):
    """The bend of an inertia curve: values cut into k equal ranges, k from 2 to 8."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("value")
    top = events.agg(F.max("value").alias("m")).scalar()
    ranges = F.transform(F.sequence(F.lit(2), F.lit(8)), lambda k: F.struct(
        k.alias("k"), F.least(F.floor(F.col("value") * k / F.col("m")), k - 1).alias("c")))
    cut = events.withColumn("m", top).select("value", F.explode(ranges).alias("p")).select("value", "p.*")
    groups = cut.groupBy("k", "c").agg((F.count("*") * F.var_pop("value")).alias("w"))
    return tu.elbow_pick(groups.groupBy("k").agg(F.sum("w").alias("inertia"))).select("k", F.round("bend", 1).alias("bend"))


@query("G5")
def kmeans_search(spark, sf_dir):
    return tu.tune_kmeans(vector_view(spark, sf_dir), [4, 8], [0.01, 0.05])


@query("G6")
def density_search(spark, sf_dir):
    df = vector_view(spark, sf_dir).withColumn("label", (F.col("label") >= 8).cast("int"))
    return tu.tune_dbscan(df, [0.3, 0.5, 0.7, 1.0, 1.15], [3, 4, 5, 7, 10], label="label")


@query("G7")
def mixture_search(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    df = events.select(F.col("event_id").alias("row_id"), F.array("value", (F.col("user_id") % 10).cast("double")).alias("features"))
    return tu.tune_mixture(df, list(range(2, 11)), ["full", "tied", "diag", "spherical"])
