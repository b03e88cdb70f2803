"""Statistical tests over the flow and syscall views."""

from __future__ import annotations

from pyspark.sql import functions as F

from secflow.functions.columns import round_doubles
from secflow.operators import hypothesis as hy
from secflow.plans.registry import query
from secflow.sources.views import FLOW_SQL, SYSCALL_SQL, flow_view, syscall_view

WF = f"WITH {FLOW_SQL} "
WE = f"WITH {SYSCALL_SQL} "
NUMS = ["sbytes", "dbytes", "spkts", "dload", "dmean"]


def _union(template: str) -> str:
    return " UNION ALL ".join(template.replace("@", c) for c in NUMS)


def _flow(spark, sf_dir):
    return flow_view(spark, sf_dir).select("label", "attack_cat", *NUMS)


@query("H1")
def ks_normality(spark, sf_dir):
    return hy.ks_normality(syscall_view(spark, sf_dir), "value")


@query("H2", WE + """, a AS (SELECT 'value' AS c, value AS x FROM syscalls UNION ALL SELECT 'returnValue', CAST(returnValue AS DOUBLE) FROM syscalls),
d AS (SELECT c, x - avg(x) OVER (PARTITION BY c) AS d FROM a),
m AS (SELECT c, count(*)::DOUBLE AS n, avg(d * d) AS m2, avg(d * d * d) AS m3, avg(d * d * d * d) AS m4 FROM d GROUP BY c),
s AS (SELECT *, m3 / m2 ** 1.5 AS skew, m4 / (m2 * m2) - 3 AS excess FROM m),
t AS (SELECT *, skew * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2))) AS y,
  sqrt(2 * (3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
  (excess + 3 - 3.0 * (n - 1) / (n + 1)) / sqrt(24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
  6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS b FROM s),
u AS (SELECT *, 6 + 8 / b * (2 / b + sqrt(1 + 4 / (b * b))) AS a FROM t),
z AS (SELECT c, skew, excess, (1 / sqrt(0.5 * ln(w2))) * asinh(y / sqrt(2 / (w2 - 1))) AS z1,
  (1 - 2 / (9 * a) - cbrt((1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))))) / sqrt(2 / (9 * a)) AS z2 FROM u)
SELECT c AS column, round(skew, 6) AS skew, round(excess, 6) AS excess, round(z1 * z1 + z2 * z2, 4) AS statistic,
round(exp(-(z1 * z1 + z2 * z2) / 2), 6) AS p_value FROM z""")
def k2_normality(spark, sf_dir):
    out = hy.k2_normality(syscall_view(spark, sf_dir), ["value", "returnValue"])
    return round_doubles(out.withColumn("statistic", F.round("statistic", 4)))


@query("H3", WF + _union(""", @_r AS (SELECT label, @ AS v, rank() OVER (ORDER BY @) + (count(*) OVER (PARTITION BY @) - 1) / 2 AS r FROM flows)""")
       .replace(" UNION ALL ", " ") + " " + _union("""SELECT '@' AS column,
round(sum(r) FILTER (label = 0) - count(*) FILTER (label = 0) * (count(*) FILTER (label = 0) + 1) / 2, 1) AS u,
round(abs(quantile_cont(CASE WHEN label = 0 THEN v END, 0.5) - quantile_cont(CASE WHEN label = 1 THEN v END, 0.5))
  / stddev_samp(v) FILTER (label = 0), 9) AS effect FROM @_r"""))
def mann_whitney(spark, sf_dir):
    out = hy.mann_whitney(_flow(spark, sf_dir), NUMS, "label")
    return out.select("column", F.round("u", 1).alias("u"), F.round("effect", 9).alias("effect"))


@query("H4", WF + """SELECT count(*) AS classes, round(sum((n - e) * (n - e) / e), 6) AS statistic FROM
(SELECT attack_cat, count(*) AS n, (SELECT count(*) FROM flows) / (SELECT count(DISTINCT attack_cat) FROM flows) AS e FROM flows GROUP BY 1)""")
def uniform_chi_square(spark, sf_dir):
    return round_doubles(hy.uniform_chi_square(_flow(spark, sf_dir), "attack_cat").drop("p_value"))


@query("H4", WE + """, c AS (SELECT count(*) / 3.0::DOUBLE AS e, count(*) FILTER (sus = 0 AND evil = 0) AS a, count(*) FILTER (sus = 1) AS b,
count(*) FILTER (evil = 1) AS d FROM syscalls) SELECT round((a - e) ** 2 / e + (b - e) ** 2 / e + (d - e) ** 2 / e, 6) AS statistic FROM c""")
def three_way_chi_square(spark, sf_dir):
    return round_doubles(hy.three_way_chi_square(syscall_view(spark, sf_dir)).drop("p_value"))


@query("H5", WF + _union(""", @_r AS (SELECT rank() OVER (ORDER BY @) + (count(*) OVER (PARTITION BY @) - 1) / 2 AS r,
rank() OVER (ORDER BY label) + (count(*) OVER (PARTITION BY label) - 1) / 2 AS y FROM flows)""").replace(" UNION ALL ", " ")
       + " SELECT \"column\", round(rho, 9) AS rho, CASE WHEN abs(rho) > 0.5 THEN 'Strong' WHEN abs(rho) > 0.3 THEN 'Moderate' ELSE 'Weak' END AS strength FROM ("
       + _union("SELECT '@' AS column, corr(r, y) AS rho FROM @_r") + ")")
def spearman(spark, sf_dir):
    return round_doubles(hy.spearman(_flow(spark, sf_dir), NUMS, "label").drop("p_value"), 9)


@query("H6 X3", WF + _union("""SELECT '@' AS column, round((sum(n * (m - g) ** 2) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 6) AS score
FROM (SELECT count(*) AS n, avg(@) AS m, var_pop(@) AS v FROM flows GROUP BY attack_cat), (SELECT avg(@) AS g FROM flows)"""))
def anova_scores(spark, sf_dir):
    return round_doubles(hy.anova(_flow(spark, sf_dir), NUMS, "attack_cat").drop("p_value"))


@query("H6 X3", WF + _union("""SELECT '@' AS column, round(sum((o - s * n / t) ** 2 / (s * n / t)), 4) AS score
FROM (SELECT count(*) AS n, sum(@ - lo) AS o FROM flows, (SELECT min(@) AS lo FROM flows) GROUP BY attack_cat),
(SELECT count(*) AS t, sum(@ - lo) AS s FROM flows, (SELECT min(@) AS lo FROM flows))"""))
def chi2_scores(spark, sf_dir):
    return round_doubles(hy.chi2_scores(_flow(spark, sf_dir), NUMS, "attack_cat").drop("p_value"), 4)


@query("H6 X3", WF + ", " + ", ".join(f"""{c}_b AS (SELECT label, b, count(*) AS c FROM
(SELECT label, floor((rank() OVER (ORDER BY {c}) - 1) * 20 / count(*) OVER ()) AS b FROM flows WHERE {c} IS NOT NULL) GROUP BY 1, 2)""" for c in NUMS) + " " + _union("""SELECT '@' AS column,
round(sum(c / n * ln(c * n / (bn * ln_))), 9) AS score FROM (SELECT c, sum(c) OVER () AS n, sum(c) OVER (PARTITION BY b) AS bn,
sum(c) OVER (PARTITION BY label) AS ln_ FROM @_b)"""))
def mutual_information_scores(spark, sf_dir):
    return round_doubles(hy.binned_mutual_information(_flow(spark, sf_dir), NUMS, "label"), 9)
