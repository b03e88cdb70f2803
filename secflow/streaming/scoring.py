"""Row-wise stages on a stream: the batch transforms are stateless, so they apply unchanged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from secflow.operators.flow_features import engineer_flows, log_flows


def flow_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """New flow files as a stream of engineered, log-transformed rows."""
    return log_flows(engineer_flows(spark.readStream.schema(schema).parquet(path)))


def write_scored(stream: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Score every micro-batch row with a fitted detector's ``predict`` and append the result.

    The checkpoint folder must be shared storage, so a restarted query goes on where it stopped.
    """
    return (
        score(stream).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
