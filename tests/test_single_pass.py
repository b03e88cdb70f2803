"""Rank and information statistics that read their rows once, against plain recomputation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from secflow.operators import hypothesis
from secflow.operators.ranking import cuts_below


def _rows(spark, n=3000):
    i = F.col("id")
    return spark.range(n).select((F.pmod(i * 7919, F.lit(97)) / 3).alias("a"), F.when(i % 11 != 0, F.pmod(i * 31, F.lit(1000)) * 1.0).alias("b"),
                                 (F.pmod(i * 13, F.lit(5)) + F.pmod(i * 7919, F.lit(97)) / 50).cast("int").alias("t"))


def _scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Range (")


def test_values_between_cuts(spark):
    cuts = [1.0, 1.0, 2.5, 4.0, 9.0, float("nan")]
    values = [-1.0, 1.0, 1.5, 2.5, 3.0, 9.0, 10.0, float("inf"), float("nan")]
    df = spark.createDataFrame([(cuts[:n], v) for n in range(7) for v in values], "cuts array<double>, v double")
    plain = F.size(F.filter("cuts", lambda c: c < F.col("v")))
    assert df.filter(cuts_below(F.col("cuts"), F.col("v"), 6) != plain).count() == 0


def test_spearman_reads_rows_once(spark):
    df = _rows(spark)
    found = hypothesis.spearman(df, ["a", "b"], "t")
    assert _scans(found) == 0
    pdf = df.toPandas()
    for r in found.collect():
        both = pdf[[r["column"], "t"]].dropna()
        want = np.corrcoef(both[r["column"]].rank(), both["t"].rank())[0, 1]
        assert abs(r["rho"] - want) < 1e-9


def test_mutual_information_reads_rows_once(spark):
    df = _rows(spark)
    found = hypothesis.binned_mutual_information(df, ["a", "b"], "t", 6)
    assert _scans(found) == 0
    pdf = df.toPandas()
    for r in found.collect():
        both = pdf[[r["column"], "t"]].dropna()
        x = both[r["column"]].to_numpy()
        n = len(x)
        bins = np.searchsorted(np.sort(x), x, "left") * 6 // n
        want = 0.0
        for b in np.unique(bins):
            for t in np.unique(both["t"]):
                c = ((bins == b) & (both["t"] == t)).sum()
                if c:
                    want += c / n * np.log(c * n / ((bins == b).sum() * (both["t"] == t).sum()))
        assert abs(r["score"] - want) < 1e-9
