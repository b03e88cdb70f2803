"""Comparison tables over the results of other steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENGINEERED = r"^(log_)?(sum|diff|ratio|both_zero|one_zero|is_integer_ratio|distance)_|^log_distance_"


def top_k(scores: DataFrame, name: str, score: str, k: int) -> DataFrame:
    return scores.orderBy(F.desc(score), name).limit(k).select(F.col(name).alias("feature"))


def agreed_features(left: DataFrame, right: DataFrame) -> DataFrame:
    """Names in both lists and whether each was engineered."""
    return left.intersect(right).withColumn("engineered", F.col("feature").rlike(ENGINEERED).cast("int"))


def engineered_share(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count("*").alias("features"), F.count_if(F.col("feature").rlike(ENGINEERED)).alias("engineered"),
        (100.0 * F.count_if(F.col("feature").rlike(ENGINEERED)) / F.count("*")).alias("engineered_pct"),
    )


def reduction(results: DataFrame, kind: str, width: str, metric: str) -> DataFrame:
    """Width saved by the selected feature set against all features, and the metric change."""
    def of(name, column):
        return F.max(F.when(F.col(kind) == name, F.col(column)))

    return results.agg(
        (100 * (1 - of("selected", width) / of("all", width))).alias("reduction_pct"),
        (of("selected", metric) - of("all", metric)).alias(f"{metric}_delta"),
    )


def metric_range(results: DataFrame, metric: str, by: list[str]) -> DataFrame:
    return results.groupBy(*by).agg((F.max(metric) - F.min(metric)).alias("range"), F.max(metric).alias("best"))


def summary_row(parts: dict[str, DataFrame]) -> DataFrame:
    """One row from one-cell tables: name -> table whose only cell becomes that column."""
    cells = [df.select(df.columns[0]).scalar().alias(name) for name, df in parts.items()]
    spark = next(iter(parts.values())).sparkSession
    return spark.range(1).select(*cells)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
