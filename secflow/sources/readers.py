"""Scans of raw tables and of stored result tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow.sources import schemas


def _scan(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported format {fmt}")
    return spark.read.schema(schema).option("header", True).format(fmt).load(path)


def read_splits(spark: SparkSession, paths: dict[str, str], schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Scan one file set per split and tag every row with its ``split``."""
    parts = [_scan(spark, path, schema, fmt).withColumn("split", F.lit(name)) for name, path in paths.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_syscalls(spark: SparkSession, paths: dict[str, str], fmt: str = "csv") -> DataFrame:
    """Raw system-call log with a ``split`` column; ``paths`` maps split name to location."""
    return read_splits(spark, paths, schemas.SYSCALL, fmt)


def read_flows(spark: SparkSession, paths: dict[str, str], fmt: str = "csv") -> DataFrame:
    """Raw flow records with a ``split`` column."""
    return read_splits(spark, paths, schemas.FLOW, fmt)


def read_datasets(
    spark: SparkSession, syscall_paths: dict[str, str], flow_paths: dict[str, str], fmt: str = "csv"
) -> dict[str, DataFrame]:
    """Both raw datasets by name."""
    return {"syscalls": read_syscalls(spark, syscall_paths, fmt), "flows": read_flows(spark, flow_paths, fmt)}


def read_result(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Stored result table; an empty table of ``schema`` when nothing is stored there."""
    try:
        return _scan(spark, path, schema, fmt)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_metrics(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Metric records stored as JSON lines."""
    return spark.read.schema(schema).json(path)


def spread_scan(scan: DataFrame, key: str) -> DataFrame:
    """A bare scan with fewer splits than task slots, spread by its key before heavy row work.

    Large inputs have more splits than slots and pass through without an exchange. Only for a
    scan: counting the splits of a plan with shuffles would run them.
    """
    slots = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= slots:
        return scan
    return scan.repartition(slots, key)
