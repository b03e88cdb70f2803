"""Feature selection: filters from one aggregate each, and model-driven searches over one cached vector table."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.operators import hypothesis, logistic_search
from secflow.operators.profiling import correlation_matrix, variances

METHODS = ("variance", "correlation", "univariate", "backward", "model_based", "lasso")


def by_variance(df: DataFrame, columns: list[str], threshold: float = 0.01) -> DataFrame:
    """(feature, variance) with population variance above the threshold."""
    found = df.agg(*[F.var_pop(c).alias(c) for c in columns]).unpivot([], columns, "feature", "variance")
    return found.filter(F.col("variance") > threshold)


def by_correlation(df: DataFrame, columns: list[str], threshold: float = 0.95) -> tuple[list[str], list[str], DataFrame]:
    """(kept, removed, pairs): of each pair above the threshold the one with the higher mean |r| goes.

    All pairs vote, also those with a column already out; equal means drop the earlier column.
    Only the d x d matrix is handled here.
    """
    spark = df.sparkSession
    long = correlation_matrix(df, columns).collect()
    place = {c: i for i, c in enumerate(columns)}
    r = np.zeros((len(columns), len(columns)))
    for row in long:
        r[place[row["left"]], place[row["right"]]] = abs(row["correlation"])
    mean = np.nanmean(r, axis=0)
    later, earlier = np.nonzero(np.tril(r > threshold, -1))
    removed = {columns[j] if mean[j] > mean[i] else columns[i] for j, i in zip(later, earlier)}
    pairs = [(columns[j], columns[i], float(r[j, i])) for j, i in zip(later, earlier)]
    return (
        [c for c in columns if c not in removed], sorted(removed),
        spark.createDataFrame(pairs, "feature string, other string, correlation double"),
    )


def univariate_scores(df: DataFrame, columns: list[str], label: str, score: str = "f") -> DataFrame:
    """(column, score) by F-test, chi-square or binned mutual information."""
    pick = {"f": hypothesis.anova, "chi2": hypothesis.chi2_scores, "mutual_info": hypothesis.binned_mutual_information}
    return pick[score](df, columns, label).select("column", "score")


def by_univariate(df: DataFrame, columns: list[str], label: str, k: int = 30, score: str = "f") -> DataFrame:
    return univariate_scores(df, columns, label, score).orderBy(F.desc("score"), "column").limit(k)


class Trials:
    """One cached vector of all columns; each trial slices the columns it needs."""

    def __init__(self, df: DataFrame, columns: list[str], label: str, seed: int = 42):
        self.columns, self.seed = list(columns), seed
        assembled = VectorAssembler(inputCols=self.columns, outputCol="_raw", handleInvalid="skip").transform(
            df.select(*columns, F.col(label).cast("double").alias("_label"))
        )
        scaled = StandardScaler(withMean=True, inputCol="_raw", outputCol="_all").fit(assembled).transform(assembled)
        self.table = scaled.select("_all", "_label").persist()
        self._two: bool | None = None

    def slice(self, names: list[str]) -> DataFrame:
        places = [self.columns.index(c) for c in names]
        return VectorSlicer(inputCol="_all", outputCol="_x", indices=places).transform(self.table).select("_x", "_label")

    def learner(self, kind: str):
        if kind == "forest":
            return RandomForestClassifier(featuresCol="_x", labelCol="_label", numTrees=20, maxDepth=6, seed=self.seed)
        return LogisticRegression(featuresCol="_x", labelCol="_label", maxIter=20, regParam=1e-4)

    def importance(self, names: list[str], kind: str) -> list[float]:
        model = self.learner(kind).fit(self.slice(names))
        if kind == "forest":
            return [float(v) for v in model.featureImportances.toArray()]
        return [float(v) for v in np.abs(model.coefficientMatrix.toArray()).max(0)]

    def accuracy(self, names: list[str], kind: str, folds: int, metric: str) -> float:
        """Mean held-out score over folds cut by a hash of the row."""
        judge = MulticlassClassificationEvaluator(labelCol="_label", metricName=metric)
        table = self.slice(names).withColumn("_fold", F.pmod(F.xxhash64(vector_to_array("_x"), "_label"), F.lit(folds)))
        scores = []
        for fold in range(folds):
            model = self.learner(kind).fit(table.filter(F.col("_fold") != fold))
            scores.append(judge.evaluate(model.transform(table.filter(F.col("_fold") == fold))))
        return float(np.mean(scores))

    def two_labels(self) -> bool:
        if self._two is None:
            known = F.count_if(F.col("_label").isin(0.0, 1.0))
            seen = self.table.agg(F.count("*").alias("n"), known.alias("k"), F.max("_label").alias("m")).head()
            self._two = seen["n"] == seen["k"] > 0 and seen["m"] == 1
        return self._two

    def accuracies(self, options: list[list[str]], folds: int) -> list[float]:
        """``accuracy`` of the logistic learner for every option, all fits advanced by the same scans."""
        learner = self.learner("logistic")
        penalty = logistic_search.Penalty(learner.getRegParam(), learner.getElasticNetParam(), learner.getMaxIter())
        places = [[self.columns.index(c) for c in names] for names in options]
        rows = self.table.select(vector_to_array("_all").alias("x"), F.col("_label").alias("y"))
        # The same deal as in ``accuracy``: by a hash of the columns in the option and the label.
        deals = [F.pmod(F.xxhash64(F.array(*[F.col("x")[i] for i in p]), "y"), F.lit(folds)).cast("int") for p in places]
        return logistic_search.subset_accuracies(rows.withColumn("fold", F.array(*deals)), len(self.columns), places, penalty, folds)

    def best(self, options: list[list[str]], kind: str, folds: int, metric: str) -> list[str]:
        """The best-scoring option, the first on ties.

        Accuracies of logistic fits on 0/1 labels come from scans shared by all options and folds; other independent fits are
        submitted side by side.
        """
        if kind == "logistic" and metric == "accuracy" and len(self.columns) <= logistic_search.MOST_COLUMNS and self.two_labels():
            return options[int(np.argmax(self.accuracies(options, folds)))]
        with ThreadPool(min(4, len(options))) as pool:
            scores = pool.map(lambda names: self.accuracy(names, kind, folds, metric), options)
        return options[int(np.argmax(scores))]

    def close(self) -> None:
        self.table.unpersist()


def by_elimination(df: DataFrame, columns: list[str], label: str, n: int, step: int = 1, kind: str = "forest") -> DataFrame:
    """(feature, ranking): each round fits once and drops the ``step`` weakest; kept features rank 1."""
    trials, left, dropped = Trials(df, columns, label), list(columns), []
    while len(left) > n:
        scores = dict(zip(left, trials.importance(left, kind)))
        weak = sorted(left, key=lambda c: (scores[c], c))[: min(step, len(left) - n)]
        dropped.append(weak)
        left = [c for c in left if c not in weak]
    trials.close()
    rows = [(c, 1) for c in left] + [(c, i + 2) for i, weak in enumerate(reversed(dropped)) for c in weak]
    return df.sparkSession.createDataFrame(rows, "feature string, ranking int")


def by_model(df: DataFrame, columns: list[str], label: str, threshold: str | float = "median", kind: str = "forest") -> DataFrame:
    """(feature, importance) at least the mean, the median or a given value."""
    trials = Trials(df, columns, label)
    scores = trials.importance(columns, kind)
    trials.close()
    cut = {"mean": np.mean, "median": np.median}[threshold](scores) if isinstance(threshold, str) else threshold
    rows = [(c, s) for c, s in zip(columns, scores) if s >= cut]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def fold_moments(df: DataFrame, columns: list[str], label: str, folds: int, key: str | None = None) -> dict[int, np.ndarray]:
    """Per fold the matrix of sums of products of (1, columns, label): all that linear models of any penalty need.

    Each batch of rows is reduced to one matrix per fold before the shuffle; ``folds`` matrices reach the driver.
    Rows with nulls are left out. Folds are dealt by a hash of the key, or of the row.
    """
    width = len(columns) + 2
    values = df.select(F.pmod(F.xxhash64(*([key] if key else [*columns, label])), F.lit(folds)).cast("int").alias("fold"),
                       F.array(F.lit(1.0), *[F.col(c).cast("double") for c in columns], F.col(label).cast("double")).alias("x"))
    whole = values.filter(~F.exists("x", lambda v: v.isNull() | F.isnan(v)))

    def partial(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            fold = batch["fold"].to_numpy()
            x = batch["x"].flatten().to_numpy().reshape(-1, width)
            for f in np.unique(fold):
                total[int(f)] = total.get(int(f), 0) + x[fold == f].T @ x[fold == f]
        yield pa.RecordBatch.from_pydict({"fold": pa.array(list(total), pa.int32()), "sums": pa.array([m.ravel() for m in total.values()], pa.list_(pa.float64()))})

    parts = whole.mapInArrow(partial, "fold int, sums array<double>").select("fold", F.posexplode("sums"))
    rows = parts.groupBy("fold", "pos").agg(F.sum("col").alias("v")).collect()
    out = {f: np.zeros(width * width) for f in range(folds)}
    for r in rows:
        out[r["fold"]][r["pos"]] = r["v"]
    return {f: m.reshape(width, width) for f, m in out.items()}


def standardised(moments: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """(correlations of the columns, their covariance with the label, means with the label's last, deviations, label variance)."""
    n = moments[0, 0]
    mean = moments[0, 1:] / n
    covariance = moments[1:, 1:] / n - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(covariance)[:-1], 0))
    spread = np.where(spread > 1e-12 * np.maximum(1, np.abs(mean[:-1])), spread, 0.0)
    scale = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
    return covariance[:-1, :-1] * np.outer(scale, scale), covariance[:-1, -1] * scale, mean, spread, float(covariance[-1, -1])


def lasso_path(gram: np.ndarray, pull: np.ndarray, alphas: np.ndarray, tolerance: float = 1e-9, most: int = 10_000) -> np.ndarray:
    """Coefficients (alpha, column) by coordinate descent on correlations, each penalty started from the one before."""
    out, b = np.zeros((len(alphas), len(pull))), np.zeros(len(pull))
    used = np.flatnonzero(np.diag(gram) > 0)
    for i, alpha in enumerate(alphas):
        for _ in range(most):
            moved = 0.0
            for j in used:
                rest = pull[j] - gram[j] @ b + gram[j, j] * b[j]
                new = np.sign(rest) * max(abs(rest) - alpha, 0) / gram[j, j]
                moved, b[j] = max(moved, abs(new - b[j])), new
            if moved < tolerance:
                break
        out[i] = b
    return out


def by_lasso(df: DataFrame, columns: list[str], label: str, folds: int = 5, steps: int = 100, least_share: float = 1e-3) -> DataFrame:
    """(feature, coefficient, alpha) left non-zero by the L1 penalty of least cross-validated error.

    One pass gathers moments per fold; ``steps`` penalties from the one that empties the model down to
    ``least_share`` of it are then fitted on matrices of the columns' size. Coefficients are of standardised columns.
    """
    by_fold = fold_moments(df, columns, label, folds)
    whole = sum(by_fold.values())
    if whole[0, 0] == 0:
        return df.sparkSession.createDataFrame([], "feature string, coefficient double, alpha double")
    gram, pull, _, _, _ = standardised(whole)
    top = float(np.abs(pull).max())
    alphas = top * least_share ** (np.arange(steps) / max(1, steps - 1)) if top > 0 else np.zeros(1)
    error = np.zeros(len(alphas))
    for held in by_fold.values():
        train = whole - held
        if held[0, 0] == 0 or train[0, 0] == 0:
            continue
        g, p, mean, spread, _ = standardised(train)
        slope = np.divide(lasso_path(g, p, alphas), spread, out=np.zeros((len(alphas), len(p))), where=spread > 0)
        # (intercept, slopes, -1) turns the held rows' products into their squared error.
        line = np.hstack([(mean[-1] - slope @ mean[:-1])[:, None], slope, -np.ones((len(alphas), 1))])
        error += np.einsum("ij,jk,ik->i", line, held, line) / held[0, 0]
    best = int(error.argmin())
    found = lasso_path(gram, pull, alphas[:best + 1])[-1]
    rows = [(c, float(v), float(alphas[best])) for c, v in zip(columns, found) if v != 0]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double, alpha double")


def stepwise(
    df: DataFrame, columns: list[str], label: str, n: int, forward: bool = True, folds: int = 3,
    metric: str = "accuracy", kind: str = "logistic",
) -> list[str]:
    """Greedy search: add (or drop) the column with the best cross-validated score until ``n`` are in."""
    trials = Trials(df, columns, label)
    chosen = [] if forward else list(columns)
    while len(chosen) != n:
        if forward:
            options = [[*chosen, c] for c in columns if c not in chosen]
        else:
            options = [[c for c in chosen if c != out] for out in chosen]
        if not options:
            break
        chosen = trials.best(options, kind, folds, metric)
    trials.close()
    return chosen


def select(df: DataFrame, columns: list[str], label: str, method: str, n: int = 30, **options) -> list[str]:
    """Names chosen by one method."""
    if method == "variance":
        kept = {r["feature"] for r in by_variance(df, columns, options.get("threshold", 0.01)).collect()}
        return [c for c in columns if c in kept]
    if method == "correlation":
        return by_correlation(df, columns, options.get("threshold", 0.95))[0]
    if method == "univariate":
        return [r["column"] for r in by_univariate(df, columns, label, n, options.get("score", "f")).collect()]
    if method == "elimination":
        return [r["feature"] for r in by_elimination(df, columns, label, n, options.get("step", 1)).filter("ranking = 1").collect()]
    if method == "model_based":
        return [r["feature"] for r in by_model(df, columns, label, options.get("threshold", "median")).collect()]
    if method == "lasso":
        return [r["feature"] for r in by_lasso(df, columns, label).collect()]
    if method in ("forward", "backward"):
        return stepwise(df, columns, label, n, method == "forward")
    raise ValueError(f"unknown method {method}")


def chain(df: DataFrame, columns: list[str], label: str, methods: list[str], n: int = 30) -> list[str]:
    """Apply methods in order, each on what the previous one kept."""
    left = list(columns)
    for m in methods:
        left = select(df, left, label, m, min(n, len(left)))
    return left


def consensus(votes: DataFrame) -> DataFrame:
    """(feature, consensus_count, one flag per method) from (method, feature) votes."""
    flags = [F.max((F.col("method") == m).cast("int")).cast("boolean").alias(m) for m in METHODS]
    return votes.groupBy("feature").agg(F.count_distinct("method").alias("consensus_count"), *flags)


def vote_histogram(table: DataFrame) -> DataFrame:
    return table.groupBy("consensus_count").agg(F.count("*").alias("features"))


def comprehensive(df: DataFrame, columns: list[str], label: str, n: int = 30) -> DataFrame:
    """Consensus of six methods, each run on all rows; no more than all columns can be asked for."""
    votes = [(m, c) for m in METHODS for c in select(df, columns, label, m, min(n, len(columns)))]
    return consensus(df.sparkSession.createDataFrame(votes, "method string, feature string"))


def agreed(table: DataFrame, least: int = 4) -> DataFrame:
    return table.filter(F.col("consensus_count") >= least).select("feature")


def method_sizes(votes: DataFrame) -> DataFrame:
    """(method, n_features) of each method's pick."""
    return votes.groupBy("method").agg(F.count_distinct("feature").alias("n_features"))


def top_features(df: DataFrame, columns: list[str], label: str, n: int = 30, method: str = "forest") -> list[str]:
    """Best ``n`` columns by forest importance, mutual information or variance."""
    if method == "variance":
        rows = variances(df, columns).orderBy(F.desc("variance"), "column").limit(n).collect()
        return [r["column"] for r in rows]
    if method == "mutual_info":
        return [r["column"] for r in by_univariate(df, columns, label, n, "mutual_info").collect()]
    rows = by_model(df, columns, label, 0.0).orderBy(F.desc("importance"), "feature").limit(n).collect()
    return [r["feature"] for r in rows]


def keep_features(df: DataFrame, chosen: list[str], label: str, texts: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The chosen columns with text features and the target put back beside them."""
    return df.select("row_id", *chosen, *texts, label)
