"""Flow queries: cleaning, encoding, pair features and the log stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from secflow.functions.columns import columns_like, continuous_types
from secflow.operators import cleaning, encoding
from secflow.operators import flow_features as ff
from secflow.operators.ranking import exact_quantiles
from secflow.plans.registry import query
from secflow.sources.views import FLOW_NUMERIC, FLOW_SQL, flow_view

WITH_FLOWS = f"WITH {FLOW_SQL} "
PAIRS = ff.find_pairs(FLOW_NUMERIC)
_EPS = "0.000001::DOUBLE"


def pair_sql(s: str, d: str) -> dict[str, str]:
    t = f"{s}_{d}"
    top = f"greatest({s} / ({d} + {_EPS}), {d} / ({s} + {_EPS}))"
    return {
        f"sum_{t}": f"{s} + {d}",
        f"diff_{t}": f"{s} - {d}",
        f"ratio_{t}": f"{s} / ({d} + {_EPS})",
        f"both_zero_{t}": f"CASE WHEN {s} = 0 AND {d} = 0 THEN 1 ELSE 0 END",
        f"one_zero_{t}": f"CASE WHEN ({s} = 0) <> ({d} = 0) THEN 1 ELSE 0 END",
        f"is_integer_ratio_{t}": f"CASE WHEN abs({top} - round_even({top}, 0)) < 0.05 THEN 1 ELSE 0 END",
        f"distance_{t}": f"abs({s} - {d}) / ({s} + {d} + {_EPS})",
        f"log_distance_{t}": f"abs(ln(1 + {s}) - ln(1 + {d}))",
    }


def _cv(s: str, d: str) -> str:
    return f"abs({s} - {d}) / 2 / (({s} + {d}) / 2 + {_EPS})"


def _case(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


_DIST = {c: f"(abs(s{c} - d{c}) / (s{c} + d{c} + {_EPS}))" for c in ("inpkt", "mean")}
GLOBAL_SQL = {
    "is_tiny_src_pkt": _case("smean < 10"),
    "is_tiny_dst_pkt": _case("dmean < 10"),
    "has_tiny_packet": _case("smean < 10 OR dmean < 10"),
    "is_extreme_src_jitter": _case("sjit > 1e6"),
    "is_extreme_dst_jitter": _case("djit > 1e6"),
    "has_extreme_jitter": _case("sjit > 1e6 OR djit > 1e6"),
    "unidirectional_loss": _case("(sloss = 0 AND dloss > 0) OR (dloss = 0 AND sloss > 0)"),
    "throughput_efficiency": f"(sbytes + dbytes) / (sinpkt + dinpkt + {_EPS})",
    "ipt_size_product_src": "sinpkt * smean",
    "ipt_size_product_dst": "dinpkt * dmean",
    "asymmetry_score": f"({_DIST['inpkt']} + {_DIST['mean']}) / 2",
    "cv_bytes": _cv("sbytes", "dbytes"),
    "cv_pkts": _cv("spkts", "dpkts"),
    "cv_ipt": _cv("sinpkt", "dinpkt"),
}
_PAIR_SQL = {k: v for s, d in PAIRS.items() for k, v in pair_sql(s, d).items()}


def _listed(exprs: dict[str, str]) -> str:
    """Arithmetic is compared exactly; only logs are rounded."""
    return ", ".join(f"round({e}, 9) AS {c}" if c.startswith("log_") else f"{e} AS {c}" for c, e in exprs.items())


def round_logs(df):
    return df.select(*[F.round(c, 9).alias(c) if c.startswith("log_") else F.col(c) for c in df.columns])


@query(
    "F2 F3 F8 F6 A15 A18",
    WITH_FLOWS
    + """SELECT label, count(*) AS flows, round(avg(distance), 9) AS mean_distance,
    round(quantile_cont(distance, 0.5), 9) AS median_distance, round(avg(one_zero), 9) AS one_zero_share,
    round(avg(log_gap), 6) AS mean_log_gap
    FROM (SELECT label, abs(sbytes - dbytes) / (sbytes + dbytes + 0.000001::DOUBLE) AS distance,
      CASE WHEN (sload = 0) <> (dload = 0) THEN 1 ELSE 0 END AS one_zero,
      sign(sbytes - dbytes) * ln(1 + abs(sbytes - dbytes)) AS log_gap FROM flows) GROUP BY label""",
)
def flow_asymmetry_by_class(spark, sf_dir):
    """How asymmetric traffic is in each class, over whole tables."""
    flows = flow_view(spark, sf_dir).select("label", "sbytes", "dbytes", "sload", "dload")
    feats = ff.engineer_flows(flows, {"sbytes": "dbytes", "sload": "dload"})
    means = feats.groupBy("label").agg(
        F.count("*").alias("flows"),
        F.round(F.avg("distance_sbytes_dbytes"), 9).alias("mean_distance"),
        F.round(F.avg("one_zero_sload_dload"), 9).alias("one_zero_share"),
        F.round(F.avg(ff.signed_log(F.col("diff_sbytes_dbytes"))), 6).alias("mean_log_gap"),
    )
    medians = exact_quantiles(feats, "distance_sbytes_dbytes", {"median_distance": 0.5}, ["label"])
    return means.join(medians.withColumn("median_distance", F.round("median_distance", 9)), "label").select(
        "label", "flows", "mean_distance", "median_distance", "one_zero_share", "mean_log_gap"
    )


@query("F1 F2 F3 F4 F5 F6 F7 F8 F9", WITH_FLOWS + f"SELECT row_id, {_listed(_PAIR_SQL)} FROM flows")
def flow_pair_features(spark, sf_dir):
    """All eight features of every discovered pair."""
    flows = flow_view(spark, sf_dir)
    new = [e.alias(c) for s, d in ff.find_pairs(flows.columns).items() for c, e in ff.pair_columns(s, d).items()]
    return round_logs(flows.select("row_id", *new))


@query("F10 F11 F12 F13 F14 F15 F16", WITH_FLOWS + f"SELECT row_id, {_listed(GLOBAL_SQL)} FROM flows")
def flow_global_features(spark, sf_dir):
    """Packet, jitter, loss, throughput, interaction, asymmetry and variation features."""
    flows = flow_view(spark, sf_dir)
    return round_logs(flows.select("row_id", *[e.alias(c) for c, e in ff.global_columns(flows.columns).items()]))


_TEXT = ["proto", "service", "state"]
_ENGINEERED = {c: c for c in FLOW_NUMERIC} | _PAIR_SQL | GLOBAL_SQL


@query("F17", WITH_FLOWS + f"SELECT row_id, label, attack_cat, proto, service, state, {_listed(_ENGINEERED)} FROM flows")
def flow_engineered(spark, sf_dir):
    """The full feature table before the log stage."""
    return round_logs(ff.engineer_flows(flow_view(spark, sf_dir)))


def log_sql(exprs: dict[str, str]) -> dict[str, str]:
    """The log stage as SQL, written against the named inputs."""
    out = {}
    for c, e in exprs.items():
        skewed = any(b in c for b in ff.SKEWED)
        if c in ff.SKEWED or c.startswith("ct_") or (c.startswith("sum_") and skewed):
            out[f"log_{c}"] = f"ln(1 + ({e}))"
        elif c.startswith("diff_") and skewed:
            out[f"log_{c}"] = f"sign({e}) * ln(1 + abs({e}))"
        else:
            out[c] = e
    return out


@query(
    "F18 F19 F20 F21 F22",
    WITH_FLOWS
    + f"SELECT row_id, label, attack_cat, proto, service, state, {_listed(log_sql(_ENGINEERED))} FROM flows",
)
def flow_log_features(spark, sf_dir):
    """The full feature table after the log stage."""
    return round_logs(ff.log_flows(ff.engineer_flows(flow_view(spark, sf_dir))))


@query(
    "C3 C10 C11 C14 J3",
    WITH_FLOWS
    + ", " + ", ".join(
        f"{c}_codes AS (SELECT {c} AS name, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT {c} FROM flows))" for c in _TEXT
    )
    + " SELECT row_id, label, attack_cat, p.code AS proto, s.code AS service, t.code AS state, "
    + ", ".join(FLOW_NUMERIC)
    + " FROM flows f JOIN proto_codes p ON f.proto = p.name JOIN service_codes s ON f.service = s.name "
    "JOIN state_codes t ON f.state = t.name",
)
def flow_clean(spark, sf_dir):
    """Incomplete rows dropped, text features coded in sorted order, gaps filled."""
    return cleaning.clean_flows(flow_view(spark, sf_dir))


@query(
    "C12 C13 J3",
    WITH_FLOWS
    + "SELECT row_id, "
    + ", ".join(
        f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v}"
        for c, vs in (("proto", "ANR"), ("service", "FO"), ("state", "FOP")) for v in vs
    )
    + " FROM flows",
)
def flow_one_hot(spark, sf_dir):
    """One 0/1 column per category, fitted on the data and reusable on unseen rows."""
    flows = flow_view(spark, sf_dir).select("row_id", *_TEXT)
    return encoding.one_hot_columns(flows, encoding.fit_codes(flows, _TEXT), _TEXT)


@query(
    "C4",
    """SELECT row_id, coalesce(CASE WHEN isnan(ratio) OR isinf(ratio) THEN 0 ELSE ratio END, 0) AS ratio,
    coalesce(note, '') AS note FROM (SELECT event_id AS row_id,
      CASE WHEN event_id % 4 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 4 = 1 THEN 'Infinity'::DOUBLE
      WHEN event_id % 4 = 2 THEN NULL ELSE value END AS ratio,
      CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS note FROM events)""",
)
def fill_gaps(spark, sf_dir):
    """Null, NaN and infinite numbers become 0, missing text becomes empty."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    part = F.col("event_id") % 4
    damaged = events.select(
        F.col("event_id").alias("row_id"),
        F.when(part == 0, float("nan")).when(part == 1, float("inf")).when(part == 2, None)
        .otherwise(F.col("value")).alias("ratio"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("note"),
    )
    return cleaning.fill_gaps(damaged)


@query(
    "C15 C16",
    WITH_FLOWS + "SELECT row_id, label, smean, dmean, ct_srv_src, ct_srv_dst, "
    "ct_src_ltm, ct_dst_ltm FROM flows",
)
def flow_column_groups(spark, sf_dir):
    """Columns picked by type, prefix and suffix; the label stays beside its features."""
    flows = flow_view(spark, sf_dir)
    wide = set(continuous_types(flows))
    picked = [c for c in columns_like(flows, suffix="mean") + columns_like(flows, prefix="ct_") if c in wide]
    return flows.select("row_id", "label", *picked)


@query(
    "C18 C19 C20",
    WITH_FLOWS
    + """SELECT row_id, CASE WHEN label = 0 THEN 'Normal' ELSE attack_cat END AS true_class,
    CASE WHEN label = 0 THEN 'Normal' ELSE 'Attack' END AS label_name FROM flows WHERE sbytes > dbytes""",
)
def flow_label_names(spark, sf_dir):
    """A predicate filter with overwritten class names."""
    flows = flow_view(spark, sf_dir).filter(F.col("sbytes") > F.col("dbytes"))
    return flows.select(
        "row_id", cleaning.true_class().alias("true_class"), cleaning.binary_label_name("label").alias("label_name")
    )
