"""Centroid and mixture detectors, cluster summaries and silhouettes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow.functions.columns import as_flag, ratio_or_zero
from secflow.functions.geometry import array_features, as_matrix, block_distances, reported
from secflow.operators.kmeans import fit_kmeans
from secflow.operators.neighbors import _vectors, grouped_blocks, side_parts, slices, summed
from secflow.operators.ranking import exact_quantiles


def as_vector(df: DataFrame, features: str = "features", output: str = "_vector") -> DataFrame:
    if isinstance(df.schema[features].dataType, VectorUDT):
        return df.withColumn(output, F.col(features))
    return df.withColumn(output, array_to_vector(features))


def group_centres(df: DataFrame, group: str, features: str = "features") -> tuple[list, np.ndarray]:
    """Mean vector of each group; groups x dimensions numbers reach the driver."""
    vectors = df.select(group, array_to_vector(array_features(df, features)).alias("v"))
    rows = vectors.groupBy(group).agg(Summarizer.mean(F.col("v")).alias("m")).orderBy(group).collect()
    return [r[0] for r in rows], np.array([r["m"].toArray() for r in rows])


def centre_scores(df: DataFrame, centres: np.ndarray, metric: str = "euclidean", features: str = "features") -> DataFrame:
    """Append ``cluster`` (nearest centre by Euclidean distance) and ``score`` (distance to it)."""

    @F.pandas_udf("struct<cluster:int,score:double>")
    def measure(values: pd.Series) -> pd.DataFrame:
        x = as_matrix(values)
        if not len(x):
            return pd.DataFrame({"cluster": pd.Series(dtype="int32"), "score": pd.Series(dtype="float64")})
        plain = block_distances(x, centres, "euclidean")
        own = plain.argmin(1)
        if metric == "euclidean":
            score = plain[np.arange(len(x)), own]
        elif metric == "manhattan":
            score = np.abs(x - centres[own]).sum(1)
        elif metric == "cosine":
            c = centres[own]
            score = 1 - (x * c).sum(1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(c, axis=1) + 1e-10)
        else:
            raise ValueError(f"unknown metric {metric}")
        return pd.DataFrame({"cluster": own.astype("int32"), "score": score})

    scored = df.withColumn("_m", measure(array_features(df, features)))
    return scored.withColumns({"cluster": F.col("_m.cluster"), "score": F.col("_m.score")}).drop("_m")


def flag_above(df: DataFrame, threshold: float | Column) -> DataFrame:
    """Append ``flag``: every detector scores upwards and flags strictly above its threshold."""
    return df.withColumn("flag", as_flag(F.col("score") > threshold))


def contamination_threshold(scored: DataFrame, contamination: float) -> float:
    """The score quantile that leaves the given share above."""
    return exact_quantiles(scored, "score", {"t": 1 - contamination}).head()["t"]


@dataclass
class KMeansDetector:
    """Distance to the nearest centre of the best of ``starts`` fits; the threshold leaves ``contamination`` of the fitted rows above."""

    k: int = 8
    contamination: float = 0.05
    metric: str = "euclidean"
    features: str = "features"
    seed: int = 42
    starts: int = 10
    centres: np.ndarray | None = None
    threshold: float | None = None
    inertia: float | None = None
    row_wise = True

    def fit(self, df: DataFrame) -> "KMeansDetector":
        best = fit_kmeans(df, [self.k], self.features, self.seed, self.starts)[self.k]
        self.centres, self.inertia = best.centres, best.inertia
        return self.calibrate(df, self.contamination)

    def calibrate(self, df: DataFrame, contamination: float) -> "KMeansDetector":
        """Move the threshold without fitting the centres again."""
        self.contamination = contamination
        self.threshold = contamination_threshold(self.score(df), contamination)
        return self

    def score(self, df: DataFrame) -> DataFrame:
        return centre_scores(df, self.centres, self.metric, self.features)

    def predict(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        return flag_above(self.score(df), self.threshold if threshold is None else threshold)


@dataclass
class Mixture:
    """Parameters of a Gaussian mixture; ``covariances`` has the shape its kind needs."""

    kind: str
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = field(default=float("nan"))
    rows: int = 0
    converged: bool = False

    def full(self) -> np.ndarray:
        k, d = self.means.shape
        if self.kind == "full":
            return self.covariances
        if self.kind == "tied":
            return np.repeat(self.covariances[None], k, 0)
        wide = self.covariances if self.kind == "diag" else np.repeat(self.covariances[:, None], d, 1)
        return np.stack([np.diag(v) for v in wide])

    def crossed(self) -> bool:
        """Whether the covariances need products of different columns."""
        return self.kind in ("full", "tied")

    def parameters(self) -> int:
        k, d = self.means.shape
        size = {"full": k * d * (d + 1) // 2, "tied": d * (d + 1) // 2, "diag": k * d, "spherical": k}[self.kind]
        return size + k * d + k - 1

    def bic(self) -> float:
        return -2 * self.log_likelihood + self.parameters() * float(np.log(self.rows))

    def aic(self) -> float:
        return -2 * self.log_likelihood + 2 * self.parameters()


def log_densities(x: np.ndarray, mixture: Mixture) -> np.ndarray:
    """log(weight * density) per row and component."""
    d = mixture.means.shape[1]
    out = np.empty((len(x), len(mixture.weights)))
    roots = None if mixture.crossed() else np.sqrt(mixture.covariances.reshape(len(mixture.weights), -1) * np.ones(d))
    for j, mean in enumerate(mixture.means):
        if roots is None:
            root = np.linalg.cholesky(mixture.covariances if mixture.kind == "tied" else mixture.covariances[j])
            solved, scale = (x - mean) @ np.linalg.inv(root).T, np.diag(root)
        else:
            solved, scale = (x - mean) / roots[j], roots[j]
        out[:, j] = np.log(mixture.weights[j] + 1e-300) - np.log(scale).sum() - 0.5 * (np.einsum("ni,ni->n", solved, solved) + d * np.log(2 * np.pi))
    return out


def _log_sum(rows: np.ndarray) -> np.ndarray:
    top = rows.max(1, keepdims=True)
    return (top + np.log(np.exp(rows - top).sum(1, keepdims=True)))[:, 0]


def mixture_scores(df: DataFrame, mixture: Mixture, features: str = "features") -> DataFrame:
    """Append ``score`` (minus log-likelihood), ``cluster`` and the component ``probabilities``."""

    @F.pandas_udf("struct<score:double,cluster:int,probabilities:array<double>>")
    def measure(values: pd.Series) -> pd.DataFrame:
        if not len(values):
            return pd.DataFrame({"score": pd.Series(dtype="float64"), "cluster": pd.Series(dtype="int32"), "probabilities": pd.Series(dtype=object)})
        logs = log_densities(as_matrix(values), mixture)
        total = _log_sum(logs)
        return pd.DataFrame({
            "score": -total, "cluster": logs.argmax(1).astype("int32"), "probabilities": list(np.exp(logs - total[:, None])),
        })

    scored = df.withColumn("_m", measure(array_features(df, features)))
    return scored.withColumns({c: F.col(f"_m.{c}") for c in ("score", "cluster", "probabilities")}).drop("_m")


def _moments(df: DataFrame, mixtures: list[Mixture], features: str) -> list[tuple]:
    """Per mixture the weighted sums for one maximisation step, all from one scan, reduced to components x dimensions by Spark."""
    def sums(batches):
        total = None
        for pdf in batches:
            if not len(pdf):
                continue
            x = as_matrix(pdf["x"])
            squares, part = x * x, []
            for m in mixtures:
                logs = log_densities(x, m)
                like = _log_sum(logs)
                share = np.exp(logs - like[:, None])
                second = np.stack([((c[:, None] * x).T @ x).ravel() for c in share.T]) if m.crossed() else share.T @ squares
                part += [np.hstack([share.sum(0)[:, None], share.T @ x, second]).ravel(), [like.sum()]]
            part = np.concatenate(part)
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"place": np.arange(len(total)), "v": total})

    parts = df.select(array_features(df, features).alias("x")).mapInPandas(sums, "place long, v double")
    shapes = [(len(m.weights), 1 + d + (d * d if m.crossed() else d)) for m in mixtures for d in m.means.shape[1:]]
    whole = np.zeros(sum(k * w + 1 for k, w in shapes))
    for r in parts.groupBy("place").agg(F.sum("v").alias("v")).collect():
        whole[r["place"]] = r["v"]
    out, at = [], 0
    for m, (k, w) in zip(mixtures, shapes):
        cells, d = whole[at:at + k * w].reshape(k, w), m.means.shape[1]
        out.append((cells[:, 0], cells[:, 1:1 + d], cells[:, 1 + d:], float(whole[at + k * w])))
        at += k * w + 1
    return out


def _maximised(kind: str, n: np.ndarray, s: np.ndarray, q: np.ndarray, floor: float) -> Mixture:
    k, d = s.shape
    n = np.maximum(n, 1e-10)
    means = s / n[:, None]
    if kind in ("full", "tied"):
        each = q.reshape(k, d, d) / n[:, None, None] - np.einsum("ki,kj->kij", means, means)
        cov = each if kind == "full" else (each * n[:, None, None]).sum(0) / n.sum()
        cov = cov + floor * np.eye(d)
    else:
        each = np.maximum(q / n[:, None] - means**2, 0) + floor
        cov = each if kind == "diag" else each.mean(1)
    return Mixture(kind, n / n.sum(), means, cov)


def fit_mixture(
    df: DataFrame, k: int, kind: str = "full", features: str = "features", seed: int = 42,
    most_rounds: int = 50, tolerance: float = 1e-3, floor: float = 1e-6, start: np.ndarray | None = None,
) -> Mixture:
    """Expectation-maximisation of one mixture, see ``fit_mixtures``."""
    return fit_mixtures(df, [(k, kind)], features, seed, most_rounds, tolerance, floor, start)[0]


def fit_mixtures(
    df: DataFrame, settings: list[tuple[int, str]], features: str = "features", seed: int = 42,
    most_rounds: int = 50, tolerance: float = 1e-3, floor: float = 1e-6, start: np.ndarray | None = None,
) -> list[Mixture]:
    """Expectation-maximisation of a mixture per (components, kind), side by side: a round is one scan for all that have
    not settled, and its result has components x dimensions cells. Mixtures of the same size share their first centres.

    Values are centred on their mean first, so that large offsets do not eat the digits of the moments.
    """
    for _, kind in settings:
        if kind not in ("full", "tied", "diag", "spherical"):
            raise ValueError(f"unknown covariance {kind}")
    df = df.select(array_features(df, features).alias(features))
    centre = np.array([r["m"] for r in df.select(F.posexplode(features).alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).orderBy("i").collect()])
    away = F.array(*[F.lit(float(c)) for c in centre])
    df = df.select(F.zip_with(features, away, lambda x, c: x - c).alias(features)).persist()  # every round scans it
    first: dict[int, np.ndarray] = {}
    for k in sorted({k for k, _ in settings}):
        if start is None:
            model = KMeans(k=k, seed=seed, featuresCol="_vector").fit(as_vector(df, features))
            first[k] = np.array([np.asarray(c) for c in model.clusterCenters()])
        else:
            first[k] = start - centre
    d = len(centre)
    spread = df.select(F.posexplode(array_features(df, features)).alias("i", "x")).groupBy("i").agg(F.var_pop("x").alias("v")).collect()
    wide = np.zeros(d)
    for r in spread:
        wide[r["i"]] = r["v"] + floor
    current, last = [], [None] * len(settings)
    for k, kind in settings:
        means = first[k]
        k = len(means)
        shape = {"full": np.repeat(np.diag(wide)[None], k, 0), "tied": np.diag(wide), "diag": np.repeat(wide[None], k, 0),
                 "spherical": np.repeat(wide.mean(), k)}[kind]
        current.append(Mixture(kind, np.full(k, 1 / k), means, shape))
    live = list(range(len(settings)))
    for turn in range(most_rounds + 1):
        if not live:
            break
        found = _moments(df, [current[i] for i in live], features)
        for i, (n, s, q, likes) in zip(list(live), found):
            m = current[i]
            m.log_likelihood, m.rows = likes, int(round(n.sum()))
            m.converged = turn < most_rounds and last[i] is not None and abs(likes - last[i]) / m.rows < tolerance
            if m.converged or turn == most_rounds:
                live.remove(i)
            else:
                last[i], current[i] = likes, _maximised(m.kind, n, s, q, floor)
    df.unpersist()
    for m in current:
        m.means = m.means + centre
    return current


def mixture_silhouettes(df: DataFrame, mixtures: list[Mixture], features: str = "features") -> list[float | None]:
    """Mean silhouette of the rows by their likeliest component, per mixture, under squared Euclidean distance; none with one cluster.

    One scan sums up the rows of every cluster, a second one adds up what follows from the sums for every row.
    """
    middle = mixtures[0].weights @ mixtures[0].means
    sizes = [len(m.weights) for m in mixtures]
    ends = np.cumsum(sizes)
    rows = df.select(array_features(df, features).alias("x"))

    def members(x: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        for m, end, k in zip(mixtures, ends, sizes):
            yield slice(end - k, end), log_densities(x, m).argmax(1)

    def add(batches):
        total = np.zeros((ends[-1], 2 + len(middle)))
        for pdf in batches:
            if not len(pdf):
                continue
            x = as_matrix(pdf["x"])
            y = x - middle
            cells = np.column_stack([np.ones(len(x)), (y * y).sum(1), y])
            for at, own in members(x):
                member = np.zeros((at.stop - at.start, len(x)))
                member[own, np.arange(len(x))] = 1
                total[at] += member @ cells
        yield pd.DataFrame({"place": np.arange(total.size), "v": total.ravel()})

    whole = np.zeros((ends[-1], 2 + len(middle)))
    for r in rows.mapInPandas(add, "place long, v double").groupBy("place").agg(F.sum("v").alias("v")).collect():
        whole[np.unravel_index(r["place"], whole.shape)] = r["v"]

    def rate(batches):
        total = np.zeros(len(mixtures))
        for pdf in batches:
            if not len(pdf):
                continue
            x = as_matrix(pdf["x"])
            y, at_row = x - middle, np.arange(len(x))
            squares = (y * y).sum(1)[:, None]
            for i, (at, own) in enumerate(members(x)):
                n, q, t = whole[at, 0], whole[at, 1], whole[at, 2:]
                far = squares + (q - 2 * y @ t.T) / np.maximum(n, 1)
                inner = far[at_row, own] * n[own] / np.maximum(n[own] - 1, 1)
                far[:, n == 0] = np.inf
                far[at_row, own] = np.inf
                outer = far.min(1)
                top = np.maximum(inner, outer)
                score = np.divide(outer - inner, top, out=np.zeros(len(x)), where=np.isfinite(outer) & (top > 0))
                total[i] += np.where(n[own] > 1, score, 0.0).sum()
        yield pd.DataFrame({"place": np.arange(len(total)), "v": total})

    found = {r["place"]: r["v"] for r in rows.mapInPandas(rate, "place long, v double").groupBy("place").agg(F.sum("v").alias("v")).collect()}
    counts = [whole[end - k:end, 0] for end, k in zip(ends, sizes)]
    return [float(found[i] / n.sum()) if (n > 0).sum() > 1 else None for i, n in enumerate(counts)]


@dataclass
class MixtureDetector:
    """Minus log-likelihood under a Gaussian mixture."""

    k: int = 5
    contamination: float = 0.05
    kind: str = "full"
    features: str = "features"
    seed: int = 42
    mixture: Mixture | None = None
    threshold: float | None = None
    row_wise = True

    def fit(self, df: DataFrame) -> "MixtureDetector":
        self.mixture = fit_mixture(df, self.k, self.kind, self.features, self.seed)
        self.threshold = contamination_threshold(self.score(df), self.contamination)
        return self

    def score(self, df: DataFrame) -> DataFrame:
        return mixture_scores(df, self.mixture, self.features)

    def predict(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        return flag_above(self.score(df), self.threshold if threshold is None else threshold)


def cluster_info(clustered: DataFrame, cluster: str = "cluster", score: str | None = "score") -> DataFrame:
    """Size, share and score range per cluster; -1 counts as noise."""
    total = clustered.agg(F.count("*").alias("n")).scalar()
    stats = [F.avg(score).alias("mean_score"), F.max(score).alias("max_score")] if score else []
    sizes = clustered.groupBy(cluster).agg(F.count("*").alias("size"), *stats)
    return sizes.withColumns({"share": F.col("size") / total, "is_noise": as_flag(F.col(cluster) == -1)})


def fit_detectors(df: DataFrame, features: str = "features", normal_only: str | None = None, **options) -> dict:
    """The standard three detectors; ``normal_only`` names a 0/1 label whose 1-rows are left out of the fit."""
    from secflow.operators.dbscan import DbscanDetector

    train = df if normal_only is None else df.filter(F.col(normal_only) == 0)
    return {
        "kmeans": KMeansDetector(features=features, **options.get("kmeans", {})).fit(train),
        "dbscan": DbscanDetector(features=features, **options.get("dbscan", {})).fit(train),
        "gmm": MixtureDetector(features=features, **options.get("gmm", {})).fit(train),
    }


def score_all(detectors: dict, df: DataFrame, thresholds: dict[str, float] | None = None, key: str = "row_id") -> DataFrame:
    """Append ``<name>_score`` and ``<name>_flag`` of every detector.

    Detectors that score a row from itself are chained over one scan; only those that look rows up, such as
    density clusters, come in by a join on the row key.
    """
    whole = F.struct(*df.columns).alias("_whole")
    out = df.select("*", whole)
    kept, looked_up = ["_whole.*"], []
    for name, detector in detectors.items():
        if not getattr(detector, "row_wise", False):
            looked_up.append(name)
            continue
        scored = detector.predict(out, (thresholds or {}).get(name))
        out = scored.select(*df.columns, "_whole", *kept[1:], F.col("score").alias(f"{name}_score"), F.col("flag").alias(f"{name}_flag"))
        kept += [f"{name}_score", f"{name}_flag"]
    out = out.select(*kept)
    for name in looked_up:
        flagged = detectors[name].predict(df, (thresholds or {}).get(name))
        out = out.join(flagged.select(key, F.col("score").alias(f"{name}_score"), F.col("flag").alias(f"{name}_flag")), key)
    return out


def sus_versus_evil(scored: DataFrame, models: list[str]) -> DataFrame:
    """Detection rates over suspicious and evil rows and mean scores of the three groups, per model."""
    entries = [F.struct(F.lit(m).alias("model"), F.col(f"{m}_score").alias("s"), F.col(f"{m}_flag").alias("f")) for m in models]
    long = scored.select("sus", "evil", F.explode(F.array(*entries)).alias("e")).select("sus", "evil", "e.*")
    sus, evil, hit = F.col("sus") == 1, F.col("evil") == 1, F.col("f") == 1

    def mean(rows):
        return F.coalesce(F.avg(F.when(rows, F.col("s"))), F.lit(0.0))

    return long.groupBy("model").agg(
        ratio_or_zero(F.count_if(sus & hit), F.count_if(sus)).alias("sus_detection_rate"),
        ratio_or_zero(F.count_if(evil & hit), F.count_if(evil)).alias("evil_detection_rate"),
        mean(~sus & ~evil).alias("avg_score_normal"),
        mean(sus & ~evil).alias("avg_score_sus"),
        mean(evil).alias("avg_score_evil"),
    )


def compare_chunks(rows: DataFrame, compare: Callable, schema: str, metric: str, block_rows: int, merge: Callable) -> DataFrame:
    """Run ``compare(left_block, right_block, distances)`` on every two blocks of ``rows`` (id, features, ...).

    A task compares two parts of the rows block by block and emits what ``merge`` makes of its frames.
    """
    parts = side_parts(rows.count(), block_rows)
    part, every = F.pmod(F.xxhash64("id"), F.lit(parts)), F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    a = rows.withColumn("lp", part.cast("int")).withColumn("rp", every)
    b = rows.withColumn("rp", part.cast("int")).withColumn("lp", every)

    def work(l: pd.DataFrame, r: pd.DataFrame):
        y, r = as_matrix(r["features"]), r.drop(columns=["features"])
        for at in slices(len(l), block_rows):
            block = l.iloc[at]
            x, block = as_matrix(block["features"]), block.drop(columns=["features"])
            for s in slices(len(r), block_rows):
                yield compare(block, r.iloc[s], reported(block_distances(x, y[s], metric), metric))

    return grouped_blocks(a, b, ["lp", "rp"], work, schema, merge)


def silhouette(
    df: DataFrame, cluster: str, metric: str = "euclidean", key: str = "row_id", features: str = "features", block_rows: int = 2048
) -> DataFrame:
    """(key, cluster, silhouette) for every row, exact.

    Cosine and squared Euclidean distances to a whole cluster follow from its sums, in time linear in the
    rows. For other metrics equal vectors of a cluster are merged with their number, and blocks are compared
    chunk by chunk and emit one distance sum per row and cluster, not the pairs; that work grows with the
    square of the distinct rows.
    """
    if metric in SUMMED_METRICS:
        return _summed_silhouette(df, cluster, metric, key, features)
    rows = _vectors(df, key, features).join(df.select(F.col(key).cast("long").alias("id"), F.col(cluster).cast("long").alias("c")), "id")
    merged = rows.groupBy("features", "c").agg(F.min("id").alias("id"), F.count("*").alias("weight")).select("id", "features", "c", "weight")

    def sums(l, r, d):
        names, spot = np.unique(r["c"].to_numpy(), return_inverse=True)
        member = np.zeros((len(r), len(names)))
        member[np.arange(len(r)), spot] = r["weight"].to_numpy()
        total = d @ member
        return pd.DataFrame({"id": np.repeat(l["id"].to_numpy(), len(names)), "other": np.tile(names, len(l)), "total": total.ravel()})

    parts = compare_chunks(merged, sums, "id long, other long, total double", metric, block_rows, summed("id", "other"))
    sizes = merged.groupBy(F.col("c").alias("other")).agg(F.sum("weight").alias("size"))
    totals = parts.groupBy("id", "other").agg(F.sum("total").alias("total")).join(F.broadcast(sizes), "other")
    joined = totals.join(merged.select("id", "c"), "id")
    own = F.col("other") == F.col("c")
    means = joined.groupBy("id", "c").agg(
        F.max(F.when(own, F.col("size"))).alias("n"),
        F.max(F.when(own & (F.col("size") > 1), F.col("total") / (F.col("size") - 1))).alias("inner"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("outer"),
    )
    value = F.when(F.col("n") == 1, 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("outer") - F.col("inner"), F.greatest("inner", "outer")), F.lit(0.0))
    )
    found = means.select(F.col("id").alias("_owner"), value.alias("silhouette"))
    owner = merged.select(F.col("id").alias("_owner"), "features", "c")
    return rows.join(owner, ["features", "c"]).join(found, "_owner").select(
        F.col("id").alias(key), F.col("c").alias(cluster), "silhouette"
    )


#: Metrics whose distance from a row to all rows of a cluster is a function of the cluster's sums.
SUMMED_METRICS = ("cosine", "sqeuclidean")


def _summed_silhouette(df: DataFrame, cluster: str, metric: str, key: str, features: str) -> DataFrame:
    """Row silhouettes from one aggregate per cluster: rows, vector sum, and sum of squares.

    Cosine works on unit vectors, a zero vector having distance 1 to all rows. One row per cluster reaches the driver.
    """
    rows = df.select(F.col(key).cast("long").alias(key), F.col(cluster).cast("long").alias(cluster), array_features(df, features).alias("_x"))
    if metric == "cosine":
        length = F.sqrt(F.aggregate("_x", F.lit(0.0), lambda a, v: a + v * v))
        rows = rows.withColumn("_n", length).withColumn("_x", F.when(F.col("_n") > 0, F.transform("_x", lambda v: v / F.col("_n"))).otherwise(F.col("_x"))).drop("_n")
    square = F.aggregate("_x", F.lit(0.0), lambda a, v: a + v * v)
    found = rows.groupBy(cluster).agg(F.count("*").alias("n"), Summarizer.sum(array_to_vector(F.col("_x"))).alias("s"), F.sum(square).alias("q")).collect()
    names = [r[cluster] for r in found]
    size, total, squares = np.array([r["n"] for r in found], float), np.array([r["s"].toArray() for r in found]), np.array([r["q"] for r in found])
    place = {c: i for i, c in enumerate(names)}

    @F.pandas_udf("double")
    def value(vectors: pd.Series, owners: pd.Series) -> pd.Series:
        x, own = as_matrix(vectors), np.array([place[c] for c in owners])
        if not len(x):
            return pd.Series([], dtype=float)
        if metric == "cosine":
            far = size - x @ total.T
        else:
            far = size * (x * x).sum(1)[:, None] + squares - 2 * x @ total.T
        far, at = np.maximum(far, 0), np.arange(len(x))
        inner = np.where(size[own] > 1, far[at, own] / np.maximum(size[own] - 1, 1), 0.0)
        others = far / size
        others[at, own] = np.inf
        outer = others.min(1)
        top = np.maximum(inner, outer)
        score = np.divide(outer - inner, top, out=np.zeros(len(x)), where=np.isfinite(outer) & (top > 0))
        return pd.Series(np.where(size[own] > 1, score, 0.0))

    return rows.select(key, cluster, value("_x", cluster).alias("silhouette"))


def silhouette_by_cluster(samples: DataFrame, cluster: str) -> DataFrame:
    return samples.groupBy(cluster).agg(
        F.count("*").alias("size"), F.avg("silhouette").alias("mean"), F.min("silhouette").alias("min"), F.max("silhouette").alias("max")
    )


def linear_silhouette(df: DataFrame, cluster: str, metric: str = "squaredEuclidean", features: str = "features") -> float:
    """Mean silhouette under squared Euclidean or cosine distance, in time linear in the rows."""
    ready = as_vector(df, features).withColumn("_c", F.col(cluster).cast("double"))
    return ClusteringEvaluator(featuresCol="_vector", predictionCol="_c", distanceMeasure=metric).evaluate(ready)


def inertia_by_metric(df: DataFrame, group: str, metrics: list[str], features: str = "features") -> DataFrame:
    """(metric, inertia): squared distance of every row to the mean of its group, summed."""
    names, centres = group_centres(df, group, features)
    place = {n: i for i, n in enumerate(names)}

    @F.pandas_udf("array<double>")
    def gaps(values: pd.Series, groups: pd.Series) -> pd.Series:
        x, c = as_matrix(values), centres[[place[g] for g in groups]]
        out = []
        for m in metrics:
            if m == "euclidean":
                d = np.linalg.norm(x - c, axis=1)
            elif m == "manhattan":
                d = np.abs(x - c).sum(1)
            else:
                d = 1 - (x * c).sum(1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(c, axis=1) + 1e-10)
            out.append(d**2)
        return pd.Series(list(np.stack(out, 1)))

    scored = df.select(gaps(array_features(df, features), F.col(group)).alias("g"))
    names_of = F.array(*[F.lit(m) for m in metrics])
    return scored.select(F.explode(F.arrays_zip(names_of.alias("metric"), F.col("g"))).alias("z")).groupBy(
        F.col("z.metric").alias("metric")
    ).agg(F.sum("z.g").alias("inertia"))


def principal_components(df: DataFrame, k: int = 2, features: str = "features", fit_on: DataFrame | None = None):
    """Rows projected on the first k components of the centred data, and the explained variance."""
    base = as_vector(fit_on if fit_on is not None else df, features)
    centre = StandardScaler(withMean=True, withStd=False, inputCol="_vector", outputCol="_centred").fit(base)
    model = PCA(k=k, inputCol="_centred", outputCol="_projected").fit(centre.transform(base))
    out = model.transform(centre.transform(as_vector(df, features)))
    projected = out.withColumn("components", vector_to_array("_projected")).drop("_vector", "_centred", "_projected")
    return projected, [float(v) for v in model.explainedVariance]
