"""Quantiles that shuffle little and scalers fitted in one pass."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from secflow.operators import ranking, scaling


def test_quantiles_keep_only_values_near_the_ranks(spark):
    x = np.random.default_rng(3).permutation(np.r_[np.arange(110_000) * 0.5, np.full(30_000, 7.25)])
    df = spark.createDataFrame([(float(v),) for v in x], "value double").withColumn("g", F.lit("a"))
    df = df.unionByName(spark.createDataFrame([("b", 3.0), ("b", 4.0), ("c", None)], "g string, value double"), allowMissingColumns=True)
    probs = {"q1": 0.0, "q2": 0.25, "q3": 0.5, "q4": 0.999, "q5": 1.0}
    assert ranking._collapsed(df, "value", list(probs.values()), ["g"]).distinct().count() < 3_000
    got = {r["g"]: list(r)[1:] for r in ranking.exact_quantiles(df, "value", probs, ["g"]).collect()}
    assert got["a"] == pytest.approx(np.quantile(x, list(probs.values())))
    assert got["b"] == pytest.approx([3.0, 3.25, 3.5, 3.999, 4.0]) and set(got) == {"a", "b"}
    alone = ranking.exact_quantiles(df.filter("g = 'a'"), "value", {"m": 0.5}).head()
    assert alone["m"] == pytest.approx(np.median(x))


def test_scaler_reads_rich_columns_once(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") * 1.5).alias("a"), (F.col("id") % 500).alias("b"))
    calls, head = [], type(df).head
    monkeypatch.setattr(type(df), "head", lambda self, *a: (a or calls.append(1), head(self, *a))[1])
    out = scaling.scale_numeric(df)
    assert len(calls) == 1
    assert out.agg(F.round(F.stddev_pop("a"), 9), F.round(F.avg("b"), 9) + 0.0).collect()[0][:] == (1.0, 0.0)
