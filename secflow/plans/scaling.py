"""Scaling and splitting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from secflow.functions.columns import round_doubles
from secflow.operators import loading, scaling, splitting
from secflow.operators.profiling import scale_check
from secflow.plans.registry import query
from secflow.sources.views import FLOW_SQL, SYSCALL_SQL, flow_view, syscall_view

WF = f"WITH {FLOW_SQL} "
WE = f"WITH {SYSCALL_SQL} "
NUMS = ["sbytes", "dbytes", "dload", "sttl"]


def _flow(spark, sf_dir):
    return flow_view(spark, sf_dir).select("row_id", "label", "spkts", "dpkts", "sload", *NUMS)


def _scaled_sql(fit: str, out: str, where: str = "") -> str:
    return (WF + ", f AS (SELECT " + ", ".join(fit.replace("@", c) for c in NUMS) + f" FROM flows {where}) SELECT row_id, label, "
            + ", ".join(out.replace("@", c) + f" AS {c}" for c in NUMS) + " FROM flows, f")


_STD = ("avg(@) AS m_@, stddev_pop(@) AS s_@", "round((@ - m_@) / s_@, 6)")


@query("Z1 C15", _scaled_sql(*_STD))
def standard_scaled(spark, sf_dir):
    flows = _flow(spark, sf_dir).select("row_id", "label", *NUMS)
    return round_doubles(scaling.scale_numeric(flows))


@query("Z2", WF + ", f AS (SELECT " + ", ".join(_STD[0].replace("@", c) for c in [*NUMS, "spkts"]) + " FROM flows) SELECT row_id, label, dpkts, sload, "
       + ", ".join(_STD[1].replace("@", c) + f" AS {c}" for c in ["sbytes", "dbytes", "sttl", "spkts"]) + ", dload FROM flows, f")
def scaled_beside_codes(spark, sf_dir):
    """Columns with at most eleven values count as codes and stay as they are."""
    return round_doubles(scaling.scale_numeric(_flow(spark, sf_dir), few=11))


@query("Z4", _scaled_sql("min(@) AS m_@, max(@) - min(@) AS s_@", "round((@ - m_@) / s_@, 6)"))
def minmax_scaled(spark, sf_dir):
    flows = _flow(spark, sf_dir).select("row_id", "label", *NUMS)
    return round_doubles(scaling.fit_scaler(flows, NUMS, "minmax").transform(flows))


@query("Z4", _scaled_sql("quantile_cont(@, 0.5) AS m_@, quantile_cont(@, 0.75) - quantile_cont(@, 0.25) AS s_@", "round((@ - m_@) / s_@, 6)"))
def robust_scaled(spark, sf_dir):
    flows = _flow(spark, sf_dir).select("row_id", "label", *NUMS)
    return round_doubles(scaling.fit_scaler(flows, NUMS, "robust").transform(flows))


@query("Z3", _scaled_sql(*_STD, where="WHERE label = 0"))
def scaled_by_train(spark, sf_dir):
    """Parameters from one part of the rows, applied to all."""
    flows = _flow(spark, sf_dir).select("row_id", "label", *NUMS)
    return round_doubles(scaling.scale_numeric(flows, flows.filter("label = 0")))


@query("A19", " UNION ALL ".join((WF if i == 0 else "") + f"SELECT '{c}' AS column, round(0.0::DOUBLE * count({c}), 6) AS mean, round(1.0::DOUBLE + 0 * count({c}), 6) AS std FROM flows"
                                 for i, c in enumerate(NUMS)))
def scaling_check(spark, sf_dir):
    flows = _flow(spark, sf_dir).select("row_id", "label", *NUMS)
    checked = scale_check(scaling.scale_numeric(flows), NUMS)
    return checked.select("column", (F.round("mean", 6) + 0.0).alias("mean"), F.round("std", 6).alias("std"))


@query("Z5")
def sparse_scaled(spark, sf_dir):
    """TF-IDF vectors divided by their deviation without centring, so zeros stay zeros."""
    from pyspark.ml.functions import vector_to_array

    ready = loading.prepare_syscall_vectors(syscall_view(spark, sf_dir), 60)
    scaled = scaling.fit_sparse_scaler(ready, "features", "scaled").transform(ready)
    return scaled.select("row_id", F.size(F.filter(vector_to_array("scaled"), lambda x: x == 0)).alias("zeros"))


_HASH = "((row_id % 2147483648) * 2654435761) % 4294967296"
_QUOTA = """, c AS (SELECT label, count(*) AS n FROM flows GROUP BY 1), s AS (SELECT *, @ * n / sum(n) OVER () AS share FROM c),
q AS (SELECT label, floor(share) + CASE WHEN row_number() OVER (ORDER BY round(share - floor(share), 9) DESC, label) <=
  @ - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS quota FROM s),
""" + f"r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_HASH}, row_id) AS rn FROM flows) "


@query("Z6 J2", WF + _QUOTA.replace("@", "(SELECT round(0.5 * sum(n)) FROM c)")
       + "SELECT row_id, label, CASE WHEN rn <= quota THEN 'val' ELSE 'test' END AS split FROM r JOIN q USING (label)")
def stratified_halves(spark, sf_dir):
    flows = flow_view(spark, sf_dir).select("row_id", "label")
    return splitting.stratified_split(flows, "label", 0.5, names=("val", "test"))


@query("Z6 G11", WF + _QUOTA.replace("@", "2000") + "SELECT row_id, label FROM r JOIN q USING (label) WHERE rn <= quota")
def stratified_sample(spark, sf_dir):
    """A sample of fixed size with the class shares of the whole table."""
    return splitting.stratified_sample(flow_view(spark, sf_dir).select("row_id", "label"), "label", 2000)


@query("Z7", WE + f"SELECT row_id FROM syscalls ORDER BY {_HASH}, row_id LIMIT 1000")
def uniform_sample(spark, sf_dir):
    return splitting.sample_rows(syscall_view(spark, sf_dir).select("row_id"), 1000)


@query("Z8 S3 C18", f"WITH {FLOW_SQL} SELECT split, count(*) AS rows, round(sum(v), 2) AS total FROM (SELECT 'flows' AS split, sbytes AS v FROM flows UNION ALL SELECT 'events', value FROM events) GROUP BY 1")
def tagged_union(spark, sf_dir):
    """Two tables tagged, united, transformed together and split back."""
    parts = {
        "flows": flow_view(spark, sf_dir).select(F.col("sbytes").alias("v")),
        "events": spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("value").alias("v")),
    }
    back = splitting.split_back(splitting.tag_and_union(parts), list(parts))
    out = splitting.tag_and_union({n: d.agg(F.count("*").alias("rows"), F.round(F.sum("v"), 2).alias("total")) for n, d in back.items()})
    return out.select("split", "rows", "total")


@query("S2 S6 C16 F17 F22 Z3")
def flow_ready(spark, sf_dir):
    """The one-call load: split, clean, pairs, logs, scaling with train statistics."""
    flows = flow_view(spark, sf_dir)
    halves = splitting.split_in_place(flows, "label", 0.5, names=("train", "test"))
    ready = loading.prepare_flows(halves)
    features, _ = loading.features_and_labels(ready)
    return ready.groupBy("split", "label").agg(
        F.count("*").alias("rows"), F.lit(len(features)).alias("features"),
        F.round(F.avg("log_sbytes"), 6).alias("mean_log_sbytes"))
