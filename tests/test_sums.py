"""Operators that work from sums alone: row silhouettes and the lasso, against plain recomputation."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from secflow.operators import anomaly, selection


def _silhouettes(x, c, metric):
    if metric == "cosine":
        n = np.linalg.norm(x, axis=1, keepdims=True)
        u = np.divide(x, n, out=np.zeros_like(x), where=n > 0)
        d = 1 - u @ u.T
    else:
        d = ((x[:, None] - x[None]) ** 2).sum(2)
    out = []
    for i in range(len(x)):
        own = c == c[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min((d[i, c == k].mean() for k in set(c) - {c[i]}), default=np.inf)
        out.append(0.0 if not np.isfinite(b) or max(a, b) <= 0 else (b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("metric", ["cosine", "sqeuclidean"])
def test_summed_silhouettes(spark, metric):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(i, 1, (30, 3)) for i in range(3)] + [np.zeros((2, 3)), np.full((1, 3), 9.0), np.full((3, 3), 2.0)])
    c = np.array([0] * 30 + [1] * 30 + [2] * 30 + [0, 1, 7, 2, 2, 2])
    df = spark.createDataFrame([(i, [float(v) for v in r], int(k)) for i, (r, k) in enumerate(zip(x, c))], "row_id long, features array<double>, g int")
    found = anomaly.silhouette(df, "g", metric).orderBy("row_id").toPandas()["silhouette"].to_numpy()
    assert np.allclose(found, _silhouettes(x, c, metric), atol=1e-9)
    one = anomaly.silhouette(df.filter("g = 0"), "g", metric)
    assert one.filter("silhouette <> 0").count() == 0 and one.count() == 31
    assert "FlatMapCoGroupsInPandas" not in anomaly.silhouette(df, "g", metric)._jdf.queryExecution().toString()


def test_lasso_meets_the_optimality_conditions(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6)) * [1, 10, 0.1, 1, 1, 1] + [0, 5, 0, 0, 100, 0]
    x[:, 5] = 3.0  # a constant column never enters
    y = 2 * x[:, 0] - 0.3 * x[:, 1] + rng.normal(size=400)
    names = [f"x{i}" for i in range(6)]
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y)] + [(None, *[0.0] * 5, 1.0), (float("nan"), *[0.0] * 5, 1.0)]
    df = spark.createDataFrame(rows, [*names, "y"]).repartition(3)
    found = selection.by_lasso(df, names, "y").collect()
    slope = {r.feature: r.coefficient for r in found}
    alpha = found[0].alpha
    assert {"x0", "x1"} <= set(slope) and "x5" not in slope
    z = (x[:, :5] - x[:, :5].mean(0)) / x[:, :5].std(0)
    b = np.array([slope.get(n, 0.0) for n in names[:5]])
    pull = z.T @ (y - y.mean() - z @ b) / 400
    assert np.allclose(pull[b != 0], alpha * np.sign(b[b != 0]), atol=1e-6) and (np.abs(pull) <= alpha + 1e-6).all()
    # The path: from an empty model, each penalty solved on its own.
    gram, own, *_ = selection.standardised(sum(selection.fold_moments(df, names, "y", 5).values()))
    alphas = np.abs(own).max() * 1e-3 ** (np.arange(100) / 99)
    path = selection.lasso_path(gram, own, alphas)
    assert not path[0].any() and (np.count_nonzero(path, axis=1)[-1] == 5) and np.allclose(path[40], selection.lasso_path(gram, own, alphas[40:41])[0], atol=1e-6)
    rest = own - path @ gram
    assert (np.abs(rest[:, :5]) <= alphas[:, None] + 1e-6).all()


def test_lasso_of_no_rows_and_of_no_signal(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (1.0, 2.0, 1.0)] * 5, ["a", "b", "y"])
    assert selection.by_lasso(df, ["a", "b"], "y").count() == 0 == selection.by_lasso(df.limit(0), ["a", "b"], "y").count()
    moments = selection.fold_moments(df.withColumn("row_id", F.monotonically_increasing_id()), ["a", "b"], "y", 3, key="row_id")
    assert sum(m[0, 0] for m in moments.values()) == 10 and set(moments) == {0, 1, 2}
