"""Logistic searches fitted side by side, against MLlib's cross-validator and its single fits."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from secflow.operators import logistic_search, selection, tuning


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 3))
    kind = rng.integers(0, 3, 500)
    y = (2 * x[:, 0] + x[:, 1] * x[:, 2] + 1.5 * (kind == 1) + rng.normal(size=500) > 0).astype(int)
    found = [(i, *map(float, v), "abc"[k], int(t)) for i, (v, k, t) in enumerate(zip(x, kind, y))]
    return spark.createDataFrame(found, "row_id long, a double, b double, c double, kind string, label int").cache()


def test_search_matches_the_cross_validator(rows, monkeypatch):
    grid = {"C": [0.01], "penalty": ["l1", "l2"]}
    cols = {"numeric": ["a", "b", "c"], "text": ["kind"]}
    with monkeypatch.context() as m:
        m.setattr(logistic_search, "MOST_COLUMNS", 0)
        want = {r["params"]: r for r in tuning.tune_logistic(rows, grid, 2, **cols).collect()}
    monkeypatch.setattr(tuning, "CrossValidator", None)  # a job per step of every fit
    got = {r["params"]: r for r in tuning.tune_logistic(rows, grid, 2, **cols).collect()}
    assert got.keys() == want.keys()
    for name, r in got.items():
        assert r["mean"] == pytest.approx(want[name]["mean"], abs=2e-4) and r["std"] == pytest.approx(want[name]["std"], abs=2e-4)


def test_side_by_side_fits_are_the_single_ones(spark):
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.normal(size=(400, 3)) * [1, 20, 0.1], np.eye(3)[rng.integers(0, 3, 400)], np.full(400, 2.0)])  # columns that depend on each other
    y = (x[:, 0] + x[:, 1] / 20 + x[:, 4] + rng.normal(size=400) > 0.3).astype(float)
    ready = spark.createDataFrame([(Vectors.dense(v), float(t)) for v, t in zip(x, y)], ["_features", "_label"])
    penalties = [logistic_search.Penalty(w, s, 1000) for w, s in ((0.01, 0.0), (0.05, 0.5), (0.02, 1.0))]
    blocks = logistic_search.packed(logistic_search.drawn(ready.coalesce(2), 2)).cache()
    fits = logistic_search.fit_folds(blocks, x.shape[1], penalties, 2)
    parts = [logistic_search._blocks([b], x.shape[1], 7) for b in blocks.toArrow().to_batches()]
    held = [tuple(np.concatenate(z) for z in zip(*p)) for p in parts]
    ones, labels, folds = (np.concatenate(z) for z in zip(*held))
    folds = folds[:, 0]
    assert sorted(map(tuple, ones[:, :-1])) == sorted(map(tuple, x)) and set(folds) == {0, 1}
    for p, per_fold in zip(penalties, fits):
        for f, w in enumerate(per_fold[:1]):
            a, t = ones[folds != f], labels[folds != f]

            def objective(c, a=a, t=t):
                return (np.logaddexp(0, a @ c) - t * (a @ c)).mean() + p.weight * (p.share * np.abs(c[:-1]).sum() + (1 - p.share) / 2 * (c[:-1] ** 2).sum())
            train = spark.createDataFrame([(Vectors.dense(v), float(z)) for v, z in zip(a[:, :-1], t)], ["_features", "_label"]).coalesce(1)
            one = LogisticRegression(featuresCol="_features", labelCol="_label", regParam=p.weight, elasticNetParam=p.share, maxIter=100, tol=1e-9,
                                     standardization=False).fit(train)
            assert objective(w) <= objective(np.r_[one.coefficients.toArray(), one.intercept]) + 1e-8


def test_a_fold_with_one_label_scores_all_rows_alike(spark):
    ready = spark.createDataFrame([(Vectors.dense([float(i)]), float(i == 0)) for i in range(40)], ["_features", "_label"]).coalesce(1)
    areas = logistic_search.cross_validated(ready, 1, [logistic_search.Penalty(0.1, 0.0, 50)], 2)
    assert sorted(areas[0]) == [0.0, 0.5]


def test_greedy_search_scores_all_options_in_shared_scans(rows, monkeypatch):
    names = ["a", "b", "c"]
    trials = selection.Trials(rows, names, "label")
    options = [["a", "c"], ["b"], ["c", "b"]]
    want = [trials.accuracy(o, "logistic", 3, "accuracy") for o in options]
    assert trials.accuracies(options, 3) == pytest.approx(want, abs=3e-3)
    monkeypatch.setattr(trials, "accuracy", None)  # a fit of its own per option and fold
    assert trials.best(options, "logistic", 3, "accuracy") == options[int(np.argmax(want))]
    trials.close()
    odd = selection.Trials(rows.withColumn("label", F.col("label") * 2), names, "label")
    assert not odd.two_labels()
    odd.close()
