"""Searches over model settings and tables that compare their results."""

from __future__ import annotations

import ast
import itertools
import random

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from secflow.functions.geometry import array_features
from secflow.operators import anomaly, evaluation, logistic_search, tree_search
from secflow.operators.boosting import Settings
from secflow.operators.density_grid import density_grid, grid_silhouettes
from secflow.operators.kmeans import fit_kmeans
from secflow.operators.supervised import BoostedClassifier, Classifier, ForestClassifier, LogisticClassifier, feature_names, fit_side_by_side
from secflow.session import cut_lineage

# The default search spaces.
LOGISTIC_GRID = {"C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0], "penalty": ["l1", "l2"]}
FOREST_GRID = {"trees": [100, 200, 300], "depth": [10, 20, 30, None], "least_leaf": [1, 2, 4], "least_split": [2, 5, 10], "subset": ["sqrt", "log2"]}
BOOSTED_GRID = {
    "trees": [100, 200, 300], "rate": [0.01, 0.05, 0.1, 0.2], "depth": [3, 6, 9], "least_weight": [1.0, 3.0, 5.0],
    "least_gain": [0.0, 0.1, 0.2], "row_share": [0.8, 1.0], "column_share": [0.8, 1.0], "l1": [0.0, 0.1, 1.0], "l2": [1.0, 2.0, 5.0],
}


def combinations(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def draw(grid: dict[str, list], n: int, seed: int = 42) -> list[dict]:
    """``n`` different settings from the grid, in a seeded order."""
    sizes = [len(v) for v in grid.values()]
    every = 1
    for size in sizes:
        every *= size
    out = []
    for number in random.Random(seed).sample(range(every), min(n, every)):
        values = []
        for size, options in zip(sizes, grid.values()):
            number, at = divmod(number, size)
            values.append(options[at])
        out.append(dict(zip(grid, values)))
    return out


def cross_validate(df: DataFrame, kind: type[Classifier], settings: list[dict], folds: int = 3, parallelism: int = 4, top: int | None = None, **fixed) -> DataFrame:
    """(params, mean, std, rank) of the area under the ROC curve, best first; ``top`` rows, or one per setting.

    Encoding and assembly run once; the folds work on one cached vector table. Logistic regressions of two classes and
    at most ``logistic_search.MOST_COLUMNS`` columns are fitted side by side, with the same folds and penalties, unless
    the whole search may take ``logistic_search.FEW_STEPS`` steps at most.
    """
    first = kind(**fixed)
    ready, rows, bins = _assembled(df, first)
    base = first.estimator(rows, 2, bins)
    others = [kind(**{**fixed, **s}).estimator(rows, 2, bins) for s in settings]
    columns = len(feature_names(ready, "_features"))
    classes = len(ready.schema["_label"].metadata.get("ml_attr", {}).get("vals", []))
    many = kind is LogisticClassifier and folds * sum(o.getMaxIter() for o in others) > logistic_search.FEW_STEPS
    if many and first.weight is None and classes == 2 and 0 < columns <= logistic_search.MOST_COLUMNS:
        penalties = [logistic_search.Penalty(o.getRegParam(), o.getElasticNetParam(), o.getMaxIter()) for o in others]
        areas = logistic_search.cross_validated(ready, columns, penalties, folds)
        found = [(a.mean(), a.std()) for a in areas]
    else:
        maps = [{base.getParam(p.name): v for p, v in o.extractParamMap().items() if base.hasParam(p.name)} for o in others]
        judge = BinaryClassificationEvaluator(labelCol="_label", metricName="areaUnderROC")
        cv = CrossValidator(estimator=base, estimatorParamMaps=maps, evaluator=judge, numFolds=folds, seed=42, parallelism=parallelism).fit(ready)
        found = list(zip(cv.avgMetrics, cv.stdMetrics))
    ready.unpersist()
    table = sorted(((s, *m) for s, m in zip(settings, found)), key=lambda t: -t[1])
    rows_out = [(str(s), float(m), float(d), i + 1) for i, (s, m, d) in enumerate(table)]
    return df.sparkSession.createDataFrame(rows_out[:top], "params string, mean double, std double, rank int").orderBy("rank")


def _ranked(spark, settings: list[dict], scores: DataFrame, top: int | None) -> DataFrame:
    """(params, mean, std, rank) from (setting, fold, auc): one row per setting leaves the cluster."""
    found = scores.groupBy("setting").agg(F.avg("auc").alias("m"), F.stddev_samp("auc").alias("d")).collect()
    table = sorted(((str(settings[r["setting"]]), r["m"], r["d"]) for r in found), key=lambda t: (-(t[1] or 0.0), t[0]))
    return spark.createDataFrame([(*t, i + 1) for i, t in enumerate(table[:top])], "params string, mean double, std double, rank int").orderBy("rank")


def _arrays(df: DataFrame, model: Classifier) -> DataFrame:
    """(row_id, features, label): the assembled table of a model kind as arrays, labels coded from 0."""
    ready, _, _ = _assembled(df, model, "row_id")
    return ready.select("row_id", vector_to_array("_features").alias("features"), F.col("_label").alias("label"))


def _assembled(df: DataFrame, model: Classifier, *keep: str) -> tuple[DataFrame, int, int]:
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    from secflow.functions.columns import numeric_columns, text_columns
    from secflow.operators import encoding, scaling
    from secflow.sources.schemas import NON_FEATURES

    numbers = model.numeric if model.numeric is not None else numeric_columns(df, [*NON_FEATURES, model.label])
    texts = model.text if model.text is not None else text_columns(df, [*NON_FEATURES, model.label])
    stages, coded = encoding.encoder_stages(texts, model.encoding)
    target = StringIndexer(inputCol=model.label, outputCol="_label", stringOrderType="alphabetAsc")
    steps = [target, *stages, VectorAssembler(inputCols=[*numbers, *coded], outputCol="_features")]
    scaled = scaling.fit_scaler(df, numbers, model.scaler).transform(df)
    fitted = Pipeline(stages=steps).fit(scaled)
    widest = max([2, *(len(ls) + 1 for s in fitted.stages[1:-1] if hasattr(s, "labelsArray") for ls in s.labelsArray)])
    ready = fitted.transform(scaled).select("_features", "_label", *keep).persist()
    return ready, ready.count(), max(32, widest)


def tune_logistic(df: DataFrame, grid: dict | None = None, folds: int = 5, **fixed) -> DataFrame:
    return cross_validate(df, LogisticClassifier, combinations(grid or LOGISTIC_GRID), folds, **fixed)


def tune_forest(df: DataFrame, grid: dict | None = None, folds: int = 3, top: int | None = None, most_rows: int | None = None, **fixed) -> DataFrame:
    """All settings of the grid on all labelled rows, or on at most ``most_rows``; a fit answers for its smaller settings."""
    settings = combinations(grid or FOREST_GRID)
    full = [{"trees": 100, "depth": None, "least_split": 2, "least_leaf": 1, "subset": "sqrt", **s} for s in settings]
    return _ranked(df.sparkSession, settings, tree_search.search_forest(_arrays(df, ForestClassifier(**fixed)), full, folds, most_rows), top)


def tune_boosted(df: DataFrame, grid: dict | None = None, n: int = 50, folds: int = 3, top: int | None = None, most_rows: int = tree_search.MOST_ROWS,
                 **fixed) -> DataFrame:
    """``n`` drawn settings on at most ``most_rows`` labelled rows; settings that differ in rounds alone share their fits."""
    settings = draw(grid or BOOSTED_GRID, n)
    return _ranked(df.sparkSession, settings, tree_search.search_boosted(_arrays(df, BoostedClassifier(**fixed)), [Settings(**s) for s in settings], folds, most_rows), top)


def best_model(table: DataFrame, kind: type[Classifier], train: DataFrame, validation: DataFrame | None = None, label: str = "label", **fixed
               ) -> tuple[Classifier, dict, float, float | None]:
    """The first setting of a search fitted on all of ``train``: (model, setting, searched area, area on ``validation``)."""
    first = table.filter("rank = 1").head()
    setting = ast.literal_eval(first["params"])
    model = kind(**fixed, **{k: v for k, v in setting.items() if k in kind.__dataclass_fields__}).fit(train)
    if validation is None:
        return model, setting, first["mean"], None
    scored = model.predict(validation).withColumn("_p1", model.positive_probability())
    return model, setting, first["mean"], evaluation.roc_auc(scored, "_p1", label).head()["auc"]


def one_factor_sweep(train: DataFrame, test: DataFrame, kind: type[Classifier], name: str, values: list, **fixed) -> DataFrame:
    """(setting, accuracy, f1, auc) with one setting varied and the others held."""
    parts = []
    for v in values:
        scored = kind(**{**fixed, name: v}).fit(train).predict(test)
        truth = scored.withColumn("_t", F.col("label").cast("string")).withColumn("_p1", F.col("probability")[1])
        basic = evaluation.classification_metrics(truth, "_t", "prediction", positive="1").withColumn("_k", F.lit(1))
        area = evaluation.roc_auc(truth, "_p1", "label").select("auc", F.lit(1).alias("_k"))
        parts.append(basic.join(area, "_k").select(F.lit(float(v)).alias(name), "accuracy", "f1", "auc"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def boosted_sweep(train: DataFrame, test: DataFrame, settings: list[dict], **fixed) -> DataFrame:
    """(setting, accuracy, precision, recall, f1, auc, train_loss) of boosted models that differ in ``settings``, grown side by side.

    The test rows are scored by all models in one pass, and their probabilities unfolded for the metrics.
    """
    models = fit_side_by_side(train, settings, **fixed)
    scored = models[0].assembled(test).select(F.col("label").cast("int").alias("label"), vector_to_array("_features").alias("x"))
    parts = [m.fitted["model"].model for m in models]

    @F.pandas_udf("array<double>")
    def positive(rows: pd.Series) -> pd.Series:
        values = np.stack(rows.to_numpy())
        return pd.Series(list(np.stack([m.probabilities(values)[:, 1] for m in parts], 1)))

    names = F.array(*[F.lit(str(s)) for s in settings])
    long = scored.select("label", F.posexplode(positive("x")).alias("i", "p")).select(F.get(names, F.col("i")).alias("setting"), "label", "p")
    long = cut_lineage(long.withColumn("flag", (F.col("p") >= 0.5).cast("int")))
    basic = evaluation.anomaly_metrics(long, "label", "flag", ["setting"]).select("setting", "accuracy", "precision", "recall", "f1")
    areas = evaluation.roc_auc(long, "p", "label", ["setting"]).select("setting", "auc")
    final = train.sparkSession.createDataFrame([(str(s), m.losses[-1][0]) for s, m in zip(settings, parts)], "setting string, train_loss double")
    return basic.join(areas, "setting").join(final, "setting")


def elbow(df: DataFrame, ks: list[int], features: str = "features", seed: int = 42, starts: int = 10) -> DataFrame:
    """(k, inertia, silhouette) of the best K-means per k, all fitted side by side; the silhouette is the linear one."""
    rows = []
    for k, best in fit_kmeans(df, ks, features, seed, starts).items():
        found = anomaly.centre_scores(df, best.centres, features=features)
        rows.append((k, best.inertia, float(anomaly.linear_silhouette(found, "cluster", features=features))))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def elbow_pick(curve: DataFrame) -> DataFrame:
    """(k): the k where the inertia curve bends most, by its second difference. One row per k comes in."""
    order = Window.orderBy("k")
    bend = F.lag("inertia").over(order) - 2 * F.col("inertia") + F.lead("inertia").over(order)
    return curve.withColumn("bend", bend).filter("bend IS NOT NULL").agg(
        F.max_by("k", F.struct("bend", -F.col("k"))).alias("k"), F.max("bend").alias("bend")
    )


def tune_kmeans(df: DataFrame, ks: list[int], contaminations: list[float], features: str = "features", key: str = "row_id", exact: bool = False) -> DataFrame:
    """(k, contamination, silhouette, threshold): fits of all k side by side; one per k serves every contamination."""
    rows = []
    for k, best in fit_kmeans(df, ks, features).items():
        detector = anomaly.KMeansDetector(k=k, features=features, centres=best.centres, inertia=best.inertia)
        scored = detector.score(df)
        if exact:
            value = anomaly.silhouette(scored, "cluster", key=key, features=features).agg(F.avg("silhouette")).head()[0]
        else:
            value = anomaly.linear_silhouette(scored, "cluster", features=features)
        rows += [(k, c, float(value), float(anomaly.contamination_threshold(scored, c))) for c in contaminations]
    return df.sparkSession.createDataFrame(rows, "k int, contamination double, silhouette double, threshold double")


def tune_dbscan(
    df: DataFrame, radii: list[float], least: list[int], label: str | None = None, features: str = "features", key: str = "row_id"
) -> DataFrame:
    """(eps, min_samples, n_clusters, n_noise, noise_ratio, silhouette, f1).

    All settings come from one pass over the distances. The silhouette covers clustered rows only; f1 scores
    noise as the anomaly flag when labels exist.
    """
    points, labels = density_grid(df, radii, least, key=key, features=features)
    positive = F.count_if(F.col(label) == 1) if label else F.lit(0)
    groups = df.groupBy(array_features(df, features).alias("_x")).agg(F.min(F.col(key).cast("long")).alias("id"), F.count("*").alias("n"), positive.alias("p"))
    groups = cut_lineage(groups.select("id", "n", "p"))
    whole = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("p"), F.lit(0)).alias("p")).head()
    inside = labels.join(groups, "id").groupBy("eps", "min_samples").agg(
        F.count_distinct("cluster").alias("clusters"), F.sum("n").alias("n"), F.sum("p").alias("p"))
    found = {(r["eps"], r["min_samples"]): (r["clusters"], r["n"], r["p"]) for r in inside.collect()}
    values = {(r["eps"], r["min_samples"]): r["silhouette"] for r in grid_silhouettes(points, labels).collect()}
    parts = []
    for eps in radii:
        for m in least:
            clusters, clustered, missed = found.get((float(eps), int(m)), (0, 0, 0))
            noise, hits = whole["n"] - clustered, whole["p"] - missed
            f1 = 2 * hits / (noise + whole["p"]) if noise + whole["p"] else 0.0
            parts.append((float(eps), int(m), clusters, noise, noise / whole["n"] if whole["n"] else None, values.get((float(eps), int(m))), f1 if label else None))
    return df.sparkSession.createDataFrame(
        parts, "eps double, min_samples long, n_clusters long, n_noise long, noise_ratio double, silhouette double, f1 double"
    )


def best_dbscan(grid: DataFrame) -> DataFrame:
    """The setting with the best f1, or the best silhouette when there are no labels."""
    return grid.orderBy(F.desc_nulls_last("f1"), F.desc_nulls_last("silhouette"), "eps", "min_samples").limit(1)


def tune_mixture(df: DataFrame, counts: list[int], kinds: list[str], features: str = "features") -> DataFrame:
    """(n_components, covariance_type, bic, aic, silhouette, converged); all mixtures are fitted side by side."""
    settings = [(k, kind) for k in counts for kind in kinds]
    rows = df.select(array_features(df, features).alias(features)).persist()
    fitted = anomaly.fit_mixtures(rows, settings, features)
    values = anomaly.mixture_silhouettes(rows, fitted, features)
    rows.unpersist()
    found = [(k, kind, float(m.bic()), float(m.aic()), value, bool(m.converged)) for (k, kind), m, value in zip(settings, fitted, values)]
    return df.sparkSession.createDataFrame(
        found, "n_components int, covariance_type string, bic double, aic double, silhouette double, converged boolean"
    )


def pivot_results(results: DataFrame, row: str, column: str, value: str, columns: list | None = None) -> DataFrame:
    """A result table with one setting down and the other across."""
    return results.groupBy(row).pivot(column, columns).agg(F.first(value))


def best_configuration(results: DataFrame, metric: str, by: list[str], order: list[str]) -> DataFrame:
    """The row with the largest metric per group, the first in ``order`` on ties."""
    best = Window.partitionBy(*by).orderBy(F.desc(metric), *order)
    return results.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r")


def baseline_versus_tuned(baseline: DataFrame, tuned: DataFrame, metrics: list[str], key: str = "model") -> DataFrame:
    """(model, metric, baseline, tuned, delta, pct)."""
    def long(df, name):
        return df.select(key, *metrics).unpivot([key], metrics, "metric", name)

    joined = long(baseline, "baseline").join(long(tuned, "tuned"), [key, "metric"])
    delta = F.col("tuned") - F.col("baseline")
    return joined.select("*", delta.alias("delta"), (100 * F.try_divide(delta, F.col("baseline"))).alias("pct"))
