"""Supervised classifiers on MLlib, with encoding and scaling fitted along with the model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from secflow.functions.columns import numeric_columns, text_columns
from secflow.operators import boosting, encoding, evaluation, scaling
from secflow.sources.schemas import NON_FEATURES

# The forest library stops at this depth; an unlimited depth means this one.
DEEPEST = 30


@dataclass
class Classifier:
    """Base: text features are encoded, numeric ones scaled, all assembled into one vector."""

    label: str = "label"
    numeric: list[str] | None = None
    text: list[str] | None = None
    encoding: str = "onehot"
    scaler: str = "none"
    weight: str | None = None
    seed: int = 42
    name: str = "model"
    fitted: dict = field(default_factory=dict)

    def estimator(self, rows: int, classes: int, bins: int):
        raise NotImplementedError

    def fit(self, df: DataFrame, validation: DataFrame | None = None) -> "Classifier":
        """Fit on ``df``; validation rows of its classes steer early stopping where the learner supports it."""
        vectors, parts, widest = self._assemble(df, validation)
        self.fitted = {**parts, "model": self.estimator(vectors.count(), len(parts["classes"]), max(32, widest)).fit(vectors)}
        vectors.unpersist()
        return self

    def _assemble(self, df: DataFrame, validation: DataFrame | None) -> tuple[DataFrame, dict, int]:
        """The cached vector table, what prediction needs to assemble rows alike, and the most categories of a text feature."""
        numbers = self.numeric if self.numeric is not None else numeric_columns(df, [*NON_FEATURES, self.label, self.weight])
        texts = self.text if self.text is not None else text_columns(df, [*NON_FEATURES, self.label])
        scaler = scaling.fit_scaler(df, numbers, self.scaler)
        keep = [*numbers, *texts, self.label, *([self.weight] if self.weight else [])]
        train = df.select(*keep)
        stages, coded = encoding.encoder_stages(texts, self.encoding)
        target = StringIndexer(inputCol=self.label, outputCol="_label", stringOrderType="alphabetAsc").fit(train)
        ready = Pipeline(stages=[*stages, VectorAssembler(inputCols=[*numbers, *coded], outputCol="_features")]).fit(train)
        rows = train
        if validation is not None and self.uses_validation():
            known = F.col(self.label).cast("string").isin(target.labels)
            held = validation.select(*keep).filter(known).withColumn("_held", F.lit(True))
            rows = train.withColumn("_held", F.lit(False)).unionByName(held)
        vectors = target.transform(ready.transform(scaler.transform(rows))).select(
            "_features", "_label", *(["_held"] if "_held" in rows.columns else []), *([self.weight] if self.weight else [])
        ).persist()
        names = target.labels
        widest = max([2, *(len(ls) + 1 for s in ready.stages[:-1] if hasattr(s, "labelsArray") for ls in s.labelsArray)])
        return vectors, {"scaler": scaler, "ready": ready, "classes": list(names), "features": feature_names(vectors, "_features")}, widest

    def uses_validation(self) -> bool:
        return False

    def predict(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        """Append ``prediction`` (class name) and ``probability`` (one entry per class, in name order).

        For two classes a ``threshold`` cuts the second class's probability instead of 0.5.
        """
        f = self.fitted
        scored = f["model"].transform(self.assembled(df.withColumn("_rows", F.struct(*df.columns))))
        shares = F.slice(vector_to_array("probability"), 1, len(f["classes"]))
        out = scored.select("_rows.*", shares.alias("probability"), F.col("prediction").cast("int").alias("_p"))
        names = F.array(*[F.lit(c) for c in f["classes"]])
        if threshold is not None:
            out = out.withColumn("_p", (F.col("probability")[1] >= threshold).cast("int"))
        return out.withColumn("prediction", names[F.col("_p")]).drop("_p")

    def assembled(self, df: DataFrame) -> DataFrame:
        """``df`` with the vector ``_features``, scaled and encoded as in the fit."""
        return self.fitted["ready"].transform(self.fitted["scaler"].transform(df))

    def positive_probability(self):
        return F.col("probability")[1]


def feature_names(df: DataFrame, column: str) -> list[str]:
    """Names of the vector slots, from the column's attribute metadata."""
    groups = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for g in groups.values() for a in g)
    return [n for _, n in slots]


@dataclass
class LogisticClassifier(Classifier):
    """Logistic regression; ``C`` is the inverse penalty summed over rows, so regParam = 1 / (C * rows)."""

    penalty: str = "l2"
    C: float = 1.0
    mix: float = 0.5
    most_rounds: int = 1000
    scaler: str = "standard"
    name: str = "logistic_regression"

    def estimator(self, rows, classes, bins):
        share = {"l1": 1.0, "l2": 0.0, "elasticnet": self.mix}[self.penalty]
        return LogisticRegression(
            featuresCol="_features", labelCol="_label", regParam=1 / (self.C * rows), elasticNetParam=share,
            maxIter=self.most_rounds, standardization=False, **({"weightCol": self.weight} if self.weight else {}),
        )

    def coefficients(self, spark, top: int | None = None) -> DataFrame:
        """(feature, coefficient) by absolute size."""
        matrix = self.fitted["model"].coefficientMatrix.toArray()
        values = matrix[0] if len(matrix) == 1 else abs(matrix).max(0)
        rows = list(zip(self.fitted["features"], map(float, values)))
        out = spark.createDataFrame(rows, "feature string, coefficient double").orderBy(F.desc(F.abs("coefficient")), "feature")
        return out.limit(top) if top else out


@dataclass
class ForestClassifier(Classifier):
    """Random forest; ``depth`` None grows to the deepest the learner supports."""

    trees: int = 100
    depth: int | None = None
    least_leaf: int = 1
    subset: str = "sqrt"
    encoding: str = "label"
    name: str = "random_forest"

    def estimator(self, rows, classes, bins):
        return RandomForestClassifier(
            featuresCol="_features", labelCol="_label", numTrees=self.trees, maxDepth=min(DEEPEST, self.depth or DEEPEST),
            minInstancesPerNode=self.least_leaf, featureSubsetStrategy=self.subset, seed=self.seed, maxBins=bins,
            # Rows remember their node, else every level would ship whole deep trees to every task.
            cacheNodeIds=True, maxMemoryInMB=1024, **({"weightCol": self.weight} if self.weight else {}),
        )

    def importances(self, spark) -> DataFrame:
        return importance_table(spark, self.fitted["features"], self.fitted["model"].featureImportances)

    def depths(self, spark) -> DataFrame:
        trees = [(t.depth,) for t in self.fitted["model"].trees]
        return spark.createDataFrame(trees, "depth int").agg(
            F.avg("depth").alias("mean"), F.max("depth").alias("max"), F.min("depth").alias("min"), F.stddev_pop("depth").alias("std")
        )


@dataclass
class _Booster:
    """The fit and transform steps of boosted trees over an assembled vector."""

    classifier: "BoostedClassifier"
    classes: int
    model: boosting.BoostedModel | None = None

    def fit(self, vectors: DataFrame) -> "_Booster":
        rows = vectors.withColumn("_array", vector_to_array("_features"))
        held = "_held" if "_held" in vectors.columns else None
        c = self.classifier
        self.model = boosting.fit_boosted(rows, [c.settings()], "_array", "_label", self.classes, c.weight, held, c.patience)[0]
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        model = self.model

        @F.pandas_udf("array<double>")
        def shares(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for part in parts:
                yield pd.Series(list(model.probabilities(np.stack(part.to_numpy()))) if len(part) else [], dtype=object)

        scored = df.withColumn("_shares", shares(vector_to_array("_features")))
        best = F.array_position("_shares", F.array_max("_shares")) - 1
        return scored.withColumns({"prediction": best.cast("double"), "probability": array_to_vector("_shares")}).drop("_shares")


@dataclass
class BoostedClassifier(Classifier):
    """Second-order boosted trees: logistic for two classes, softmax for more; ``l1`` and ``l2`` penalise leaf values."""

    trees: int = 100
    rate: float = 0.1
    depth: int = 6
    least_weight: float = 1.0
    least_gain: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    l1: float = 0.0
    l2: float = 1.0
    encoding: str = "category"
    early_stop: bool = False
    patience: int = 10
    name: str = "boosted_trees"

    def uses_validation(self) -> bool:
        return self.early_stop

    def settings(self) -> boosting.Settings:
        return boosting.Settings(self.trees, self.rate, self.depth, self.least_weight, self.least_gain, self.row_share, self.column_share,
                                 self.l1, self.l2, self.seed)

    def estimator(self, rows, classes, bins):
        return _Booster(self, max(2, classes))

    def nodes(self, spark) -> DataFrame:
        """All nodes of all trees; their number is bounded by rounds and depth."""
        return spark.createDataFrame(self.fitted["model"].model.node_rows(), boosting.NODES)

    def losses(self, spark) -> DataFrame:
        """(round, train, held): mean log loss after each round, 0 for none; held is null without validation rows."""
        rows = [(i, *x) for i, x in enumerate(self.fitted["model"].model.losses)]
        return spark.createDataFrame(rows, "round int, train double, held double")

    def importances(self, spark, kind: str = "gain") -> DataFrame:
        """Importance by mean gain per split, number of splits (``weight``) or mean hessian per split (``cover``)."""
        value = {"gain": F.avg("gain"), "weight": F.count("*").cast("double"), "cover": F.avg("cover")}[kind]
        per = self.nodes(spark).filter("left IS NOT NULL").groupBy(F.col("feature").alias("i")).agg(value.alias("importance"))
        names = spark.createDataFrame(list(enumerate(self.fitted["features"])), "i int, feature string")
        return names.join(per, "i", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))


def fit_side_by_side(df: DataFrame, settings: list[dict], **fixed) -> list[BoostedClassifier]:
    """One boosted classifier per setting, grown in the same passes over one assembled table; no early stopping."""
    models = [BoostedClassifier(**{**fixed, **s}) for s in settings]
    vectors, parts, _ = models[0]._assemble(df, None)
    classes = max(2, len(parts["classes"]))
    rows = vectors.withColumn("_array", vector_to_array("_features"))
    for m, found in zip(models, boosting.fit_boosted(rows, [m.settings() for m in models], "_array", "_label", classes, models[0].weight)):
        m.fitted = {**parts, "model": _Booster(m, classes, found)}
    vectors.unpersist()
    return models


def importance_table(spark, names: list[str], vector) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, vector.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


def train_standard(df: DataFrame, validation: DataFrame | None = None, **options) -> dict[str, Classifier]:
    """The standard three classifiers by name."""
    models = [
        LogisticClassifier(**options.get("logistic_regression", {})),
        ForestClassifier(**options.get("random_forest", {})),
        BoostedClassifier(**options.get("boosted_trees", {})),
    ]
    return {m.name: m.fit(df, validation) for m in models}


def compare_classifiers(models: dict[str, Classifier], df: DataFrame, label: str = "label", positive: str = "1") -> DataFrame:
    """(model, accuracy, precision, recall, f1, classes) of fitted models on one table."""
    return evaluation.compare_models([
        (n, evaluation.classification_metrics(m.predict(df).withColumn("_t", F.col(label).cast("string")), "_t", "prediction", positive=positive))
        for n, m in models.items()
    ])


def prediction_table(models: dict[str, Classifier], df: DataFrame, label: str = "label", key: str = "row_id") -> DataFrame:
    """(key, true label, ``<model>_pred`` and ``<model>_proba`` per model), all models over one scan of the rows."""
    out, found = df, []
    for n, m in models.items():
        scored = m.predict(out.drop("prediction", "probability"))
        out = scored.withColumns({f"{n}_pred": F.col("prediction"), f"{n}_proba": m.positive_probability()})
        found += [f"{n}_pred", f"{n}_proba"]
    return out.select(key, F.col(label).alias("true_label"), *found)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight): rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    every = Window.partitionBy(F.lit(0))  # one row per class
    return counts.select(label, (F.sum("_n").over(every) / (F.count("*").over(every) * F.col("_n"))).alias("weight"))
