from __future__ import annotations

from pyspark.sql import functions as F

from secflow.operators.anomaly import flag_above
from secflow.operators.flow_features import engineer_flows, log_flows
from secflow.streaming.scoring import flow_stream, write_scored


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(50).select(
        F.col("id").alias("row_id"), (F.col("id") * 3.0).alias("sbytes"), (F.col("id") % 7 * 1.0).alias("dbytes"))
    source = str(tmp_path / "in")
    rows.write.parquet(source)

    def score(df):
        return flag_above(df.withColumn("score", F.col("distance_sbytes_dbytes")), 0.5)

    query = write_scored(flow_stream(spark, source, rows.schema), score, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(60)
    want = score(log_flows(engineer_flows(rows)))
    got = spark.read.parquet(str(tmp_path / "out")).select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect())
