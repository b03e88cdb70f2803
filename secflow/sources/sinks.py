"""Sinks for processed tables, result tables and metric records."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_processed(df: DataFrame, path: str, fmt: str = "parquet", suffix: str = "") -> str:
    """Write one folder per split so later reads prune to the split they need."""
    target = f"{path}{suffix}"
    writer = df.write.mode("overwrite").partitionBy("split")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(target)
    return target


def write_result(df: DataFrame, path: str) -> str:
    """Write a metric-sized table (a row per model, class or threshold) as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_metrics(df: DataFrame, path: str) -> str:
    """Write metric records as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path
