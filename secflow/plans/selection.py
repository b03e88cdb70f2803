"""Feature selection queries on the flow view."""

from __future__ import annotations

from pyspark.sql import functions as F

from secflow.functions.columns import round_doubles
from secflow.operators import selection as sel
from secflow.operators.flow_features import engineer_flows
from secflow.plans.registry import query
from secflow.sources.views import FLOW_SQL, flow_view

WF = f"WITH {FLOW_SQL} "
BASE = ["sbytes", "dbytes", "spkts", "sload", "dload", "sjit", "smean", "sinpkt"]
EXTRA = {"sum_sbytes_dbytes": "sbytes + dbytes", "diff_sbytes_dbytes": "sbytes - dbytes"}
ALL = [*BASE, *EXTRA]
WITH = WF + ", x AS (SELECT label, " + ", ".join([*BASE, *(f"{e} AS {c}" for c, e in EXTRA.items())]) + " FROM flows) "


def _union(template: str) -> str:
    return " UNION ALL ".join(template.replace("@", c) for c in ALL)


def _flow(spark, sf_dir):
    flows = flow_view(spark, sf_dir).select("label", *BASE)
    return engineer_flows(flows, {"sbytes": "dbytes"}).select("label", *ALL)


VARIANCE = WITH + ", v AS (" + _union("SELECT '@' AS feature, var_pop(@) AS variance FROM x") + ") "
_CORR = ", names AS (" + " UNION ALL ".join(f"SELECT '{c}' AS f, {i} AS i" for i, c in enumerate(ALL)) + "), r AS (" + " UNION ALL ".join(
    f"SELECT {i} AS a, {j} AS b, abs(corr({c}, {d})) AS r FROM x" for i, c in enumerate(ALL) for j, d in enumerate(ALL)) + """),
m AS (SELECT a, avg(r) AS m FROM r GROUP BY a), high AS (SELECT r.a, r.b, r.r, ma.m AS ma, mb.m AS mb FROM r JOIN m ma ON ma.a = r.a JOIN m mb ON mb.a = r.b
  WHERE r.a > r.b AND r.r > 0.9), gone AS (SELECT DISTINCT CASE WHEN ma > mb THEN a ELSE b END AS i FROM high) """
_F = ", f AS (" + _union("""SELECT '@' AS feature, (sum(n * (m - g) ** 2) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS score
FROM (SELECT count(*) AS n, avg(@) AS m, var_pop(@) AS v FROM x GROUP BY label), (SELECT avg(@) AS g FROM x)""") + ") "


@query("X1", VARIANCE + "SELECT feature, round(ln(variance), 9) AS log_variance FROM v WHERE variance > 0.01")
def variance_selection(spark, sf_dir):
    kept = sel.by_variance(_flow(spark, sf_dir), ALL)
    return kept.select("feature", F.round(F.log("variance"), 9).alias("log_variance"))


@query("X2", WITH + _CORR + "SELECT f AS feature FROM names WHERE i NOT IN (SELECT i FROM gone)")
def correlation_selection(spark, sf_dir):
    kept, _, _ = sel.by_correlation(_flow(spark, sf_dir), ALL, 0.9)
    return spark.createDataFrame([(c,) for c in kept], "feature string")


@query("X2 A12", WITH + _CORR + "SELECT p.f AS feature, q.f AS other, round(r, 6) AS correlation FROM high JOIN names p ON p.i = a JOIN names q ON q.i = b")
def correlated_pairs(spark, sf_dir):
    return round_doubles(sel.by_correlation(_flow(spark, sf_dir), ALL, 0.9)[2])


@query("X3", WITH + _F + "SELECT feature AS \"column\", round(score, 6) AS score FROM f ORDER BY score DESC, feature LIMIT 4")
def univariate_selection(spark, sf_dir):
    return round_doubles(sel.by_univariate(_flow(spark, sf_dir), ALL, "label", 4))


@query("X12 A10", WITH + ", v AS (" + _union("SELECT '@' AS feature, var_samp(@) AS variance FROM x") + ") SELECT feature FROM v ORDER BY variance DESC, feature LIMIT 5")
def top_features_by_variance(spark, sf_dir):
    df = _flow(spark, sf_dir)
    return spark.createDataFrame([(c,) for c in sel.top_features(df, ALL, "label", 5, "variance")], "feature string")


_VOTES = WITH + _CORR + _F + ", v AS (" + _union("SELECT '@' AS feature, var_pop(@) AS variance FROM x") + """),
top AS (SELECT feature FROM f ORDER BY score DESC, feature LIMIT 4),
votes AS (SELECT 'variance' AS method, feature FROM v WHERE variance > 0.01 UNION ALL SELECT 'correlation', f FROM names WHERE i NOT IN (SELECT i FROM gone)
UNION ALL SELECT 'univariate', feature FROM top UNION ALL SELECT 'backward', feature FROM top),
consensus AS (SELECT feature, count(*) AS consensus_count, bool_or(method = 'variance') AS variance, bool_or(method = 'correlation') AS correlation,
bool_or(method = 'univariate') AS univariate, bool_or(method = 'backward') AS backward, false AS model_based, false AS lasso FROM votes GROUP BY feature) """


def _votes(spark, sf_dir):
    df = _flow(spark, sf_dir)
    univariate = sel.by_univariate(df, ALL, "label", 4).select(F.col("column").alias("feature"))
    kept = spark.createDataFrame([(c,) for c in sel.by_correlation(df, ALL, 0.9)[0]], "feature string")
    picks = {"variance": sel.by_variance(df, ALL).select("feature"), "correlation": kept, "univariate": univariate, "backward": univariate}
    parts = [d.select(F.lit(m).alias("method"), "feature") for m, d in picks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("X10", _VOTES + "SELECT * FROM consensus")
def selection_consensus(spark, sf_dir):
    """Votes of the filter methods; the slow backward search is stood in for by the univariate pick."""
    return sel.consensus(_votes(spark, sf_dir))


@query("X10", _VOTES + "SELECT consensus_count, count(*) AS features FROM consensus GROUP BY 1")
def selection_vote_histogram(spark, sf_dir):
    return sel.vote_histogram(sel.consensus(_votes(spark, sf_dir)))


@query("X10", _VOTES + "SELECT feature FROM consensus WHERE consensus_count >= 4")
def selection_agreed(spark, sf_dir):
    return sel.agreed(sel.consensus(_votes(spark, sf_dir)))


@query("X11", _VOTES + "SELECT method, count(*) AS n_features FROM votes GROUP BY method")
def selection_sizes(spark, sf_dir):
    return sel.method_sizes(_votes(spark, sf_dir))


@query("X4")
def selection_by_elimination(spark, sf_dir):
    return sel.by_elimination(_flow(spark, sf_dir), ALL, "label", 4, 3)


@query("X5")
def selection_by_model(spark, sf_dir):
    return sel.by_model(_flow(spark, sf_dir), ALL, "label")


@query("X6")
def selection_by_lasso(spark, sf_dir):
    df = _flow(spark, sf_dir).withColumn("label", (F.col("sbytes") > 30000).cast("int"))
    return sel.by_lasso(df, BASE, "label")


def _named(spark, method, chosen):
    return spark.createDataFrame([(method, i, c) for i, c in enumerate(chosen)], "method string, place int, feature string")


@query("X7")
def selection_forward(spark, sf_dir):
    return _named(spark, "forward", sel.stepwise(_flow(spark, sf_dir), BASE, "label", 2, True))


@query("X8")
def selection_backward(spark, sf_dir):
    return _named(spark, "backward", sel.stepwise(_flow(spark, sf_dir), BASE, "label", 3, False))


@query("X9")
def selection_chain(spark, sf_dir):
    return _named(spark, "chain", sel.chain(_flow(spark, sf_dir), ALL, "label", ["variance", "correlation", "univariate"], 4))


@query("X10 X12")
def selection_of_six_methods(spark, sf_dir):
    return sel.comprehensive(_flow(spark, sf_dir), BASE, "label", 4)
