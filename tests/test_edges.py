"""Inputs that no table shows: absent classes, constants, far offsets, hubs and empty sides."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from secflow.operators.anomaly import fit_mixture
from secflow.operators.dbscan import dbscan
from secflow.operators.evaluation import classification_metrics
from secflow.operators.hypothesis import binned_mutual_information
from secflow.operators.neighbors import pairs_within
from secflow.operators.profiling import histogram
from secflow.operators.supervised import BoostedClassifier
from secflow.sources.views import flow_view


def test_flow_view_keeps_every_line(spark):
    sf = "/root/testdata/sf0.01"
    flows = flow_view(spark, sf)
    assert flows.count() == spark.read.parquet(f"{sf}/lineitem.parquet").count() == flows.select("row_id").distinct().count()


def test_histogram_of_a_constant(spark):
    rows = histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), "v", 2).collect()
    assert sum(r["count"] for r in rows) == 4


def test_metrics_without_the_positive_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = classification_metrics(df, "y", "p", positive=1).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_mixture_far_from_zero(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (80, 2)), rng.normal(9, 1, (80, 2))]) + 1e8
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "row_id long, features array<double>")
    means = np.sort(fit_mixture(df, 2).means[:, 0]) - 1e8
    assert abs(means[0]) < 1 and abs(means[1] - 9) < 1


def test_hub_with_more_spokes_than_a_block(spark):
    spokes = [[float(np.cos(a)), float(np.sin(a))] for a in np.linspace(0, 2 * np.pi, 60, endpoint=False)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([[0.0, 0.0], *spokes])], "row_id long, features array<double>")
    found = dbscan(df, 1.0, 30, block_rows=16)
    assert found.count() == 61


def test_pairs_of_no_rows(spark):
    df = spark.createDataFrame([(1, [0.0])], "row_id long, features array<double>").where(F.lit(False))
    assert pairs_within(df, 1.0).count() == 0


def test_mutual_information_of_a_heavy_tail(spark):
    x = [*np.exp(np.random.default_rng(5).normal(0, 2, 400)), 1e12]
    rows = [(float(v), int(v > 1)) for v in x]
    df = spark.createDataFrame([*rows, (None, 1)], "v double, label int")
    assert 0.6 < binned_mutual_information(df, ["v"], "label").first()["score"] <= np.log(2)


def test_encoders_do_not_see_validation_rows(spark):
    train = spark.createDataFrame([(i, float(i % 7), "ab"[i % 2], i % 2) for i in range(40)], "row_id int, x double, proto string, label int")
    held = spark.createDataFrame([(100, 1.0, "z", 0), (101, 2.0, "a", 1), (102, 3.0, "a", 7)], train.schema)
    model = BoostedClassifier(numeric=["x"], text=["proto"], trees=2, depth=2, early_stop=True).fit(train, held)
    assert list(map(list, model.fitted["ready"].stages[0].labelsArray)) == [["a", "b"]] and model.fitted["classes"] == ["0", "1"]
