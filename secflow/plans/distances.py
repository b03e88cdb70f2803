"""Vector queries: neighbours, centre scores, density clusters, mixtures, silhouettes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from secflow.functions.columns import round_doubles
from secflow.operators import anomaly as an
from secflow.operators import dbscan as db
from secflow.operators import density_grid as grid
from secflow.operators import neighbors as nb
from secflow.plans.registry import query
from secflow.sources.views import SYSCALL_SQL, VECTORS_SQL, syscall_view, vector_view

WV = f"WITH {VECTORS_SQL} "
WE = f"WITH {SYSCALL_SQL} "
EPS, MIN_SAMPLES = 1.15, 4
_CENTRES = """, parts AS (SELECT label, generate_subscripts(features, 1) AS i, unnest(features) AS x FROM vectors),
means AS (SELECT label, i, avg(x) AS m FROM parts GROUP BY 1, 2),
centres AS (SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster, list(m ORDER BY i) AS c FROM means GROUP BY label),
own AS (SELECT row_id, features, label, arg_min(cluster, list_distance(features, c)) AS cluster, min(list_distance(features, c)) AS score
  FROM vectors, centres GROUP BY 1, 2, 3) """


def _centred(spark, sf_dir, metric="euclidean"):
    vectors = vector_view(spark, sf_dir)
    _, centres = an.group_centres(vectors, "label")
    return an.centre_scores(vectors, centres, metric)


@query("U1 J3", WV + _CENTRES + "SELECT row_id, cluster, round(score, 6) AS score FROM own")
def centre_scores(spark, sf_dir):
    """Distance to the nearest centre; the centres are the group means."""
    return round_doubles(_centred(spark, sf_dir).select("row_id", "cluster", "score"))


@query("U1", WV + _CENTRES + """SELECT row_id, CASE WHEN score > (SELECT quantile_cont(score, 0.95) FROM own) THEN 1 ELSE 0 END AS flag FROM own""")
def centre_flags(spark, sf_dir):
    """Rows above the threshold that leaves five percent flagged."""
    scored = _centred(spark, sf_dir)
    return an.flag_above(scored, an.contamination_threshold(scored, 0.05)).select("row_id", "flag")


@query("U2", WV + _CENTRES + """, ids AS (SELECT row_id, o.cluster, unnest(features) AS x, unnest(c) AS y FROM own o JOIN centres USING (cluster))
SELECT row_id, cluster, round(sum(abs(x - y)), 6) AS score FROM ids GROUP BY 1, 2""")
def centre_scores_manhattan(spark, sf_dir):
    return round_doubles(_centred(spark, sf_dir, "manhattan").select("row_id", "cluster", "score"))


@query("U2", WV + _CENTRES + """, ids AS (SELECT row_id, o.cluster, unnest(features) AS x, unnest(c) AS y FROM own o JOIN centres USING (cluster))
SELECT row_id, cluster, round(1 - sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y)) + 1e-10), 6) AS score FROM ids GROUP BY 1, 2""")
def centre_scores_cosine(spark, sf_dir):
    return round_doubles(_centred(spark, sf_dir, "cosine").select("row_id", "cluster", "score"))


@query("U9", WV + _CENTRES + """SELECT cluster, count(*) AS size, round(avg(score), 6) AS mean_score, round(max(score), 6) AS max_score,
round(count(*) / (SELECT count(*) FROM own), 6) AS share, 0 AS is_noise FROM own GROUP BY cluster""")
def cluster_sizes(spark, sf_dir):
    return round_doubles(an.cluster_info(_centred(spark, sf_dir)))


_NEAR = """SELECT row_id, neighbor, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM (
SELECT a.row_id, b.row_id AS neighbor, @ AS distance, row_number() OVER (PARTITION BY a.row_id ORDER BY @, b.row_id) AS rank
FROM vectors a, vectors b WHERE # ) WHERE rank <= $"""


def _near(metric: str, where: str, k: int) -> str:
    return WV + _NEAR.replace("@", f"{metric}(a.features, b.features)").replace("#", where).replace("$", str(k))


@query("J4 U12", _near("list_distance", "a.row_id <> b.row_id", 3))
def nearest_neighbours(spark, sf_dir):
    vectors = vector_view(spark, sf_dir)
    return round_doubles(nb.nearest(vectors, vectors, 3, exclude_self=True))


@query("J4 U12", _near("list_cosine_distance", "a.row_id <> b.row_id", 2))
def nearest_neighbours_cosine(spark, sf_dir):
    vectors = vector_view(spark, sf_dir)
    return round_doubles(nb.nearest(vectors, vectors, 2, "cosine", exclude_self=True))


@query("U6 J4", _near("list_distance", "b.label < 5", 1))
def nearest_normal(spark, sf_dir):
    """Raw distance to the nearest row of the normal groups, for every row."""
    vectors = vector_view(spark, sf_dir)
    return round_doubles(nb.nearest(vectors, vectors.filter("label < 5"), 1))


@query("J5 U12", WV + """SELECT a.row_id AS left, b.row_id AS right, round(list_distance(a.features, b.features), 6) AS distance
FROM vectors a, vectors b WHERE a.row_id < b.row_id AND list_distance(a.features, b.features) <= 1.15""")
def close_pairs(spark, sf_dir):
    return round_doubles(nb.pairs_within(vector_view(spark, sf_dir), EPS))


def _density(where: str = "TRUE", eps: float = EPS, least: int = MIN_SAMPLES) -> str:
    return f"""WITH RECURSIVE {VECTORS_SQL}, t AS (SELECT * FROM vectors WHERE {where}),
near AS (SELECT a.row_id AS a, b.row_id AS b, list_distance(a.features, b.features) AS d FROM t a, t b WHERE list_distance(a.features, b.features) <= {eps}),
core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {least}),
cc AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach AS (SELECT a, b FROM cc UNION SELECT r.a, c.b FROM reach r JOIN cc c ON r.b = c.a),
comp AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a),
border AS (SELECT a AS id, arg_min(b, struct_pack(d := d, b := b)) AS b FROM near WHERE a NOT IN (SELECT id FROM core) AND b IN (SELECT id FROM core) GROUP BY a),
raw AS (SELECT id, component, 1 AS is_core FROM comp UNION ALL SELECT border.id, component, 0 FROM border JOIN comp ON border.b = comp.id),
numbered AS (SELECT id, CAST(dense_rank() OVER (ORDER BY component) - 1 AS BIGINT) AS cluster, is_core FROM raw),
clusters AS (SELECT t.row_id, coalesce(cluster, -1) AS cluster, coalesce(is_core, 0) AS is_core FROM t LEFT JOIN numbered ON id = t.row_id) """


@query("U3 J5", _density() + "SELECT row_id, cluster, is_core FROM clusters")
def density_clusters(spark, sf_dir):
    return db.dbscan(vector_view(spark, sf_dir), EPS, MIN_SAMPLES)


@query("U3 G6", f"""WITH RECURSIVE {VECTORS_SQL}, s AS (SELECT eps, least FROM (SELECT unnest([1.05, 1.1, 1.15]) AS eps), (SELECT unnest([3, 5]) AS least)),
near AS (SELECT a.row_id AS a, b.row_id AS b, list_distance(a.features, b.features) AS d FROM vectors a, vectors b WHERE list_distance(a.features, b.features) <= 1.15),
core AS (SELECT eps, least, a AS id FROM near JOIN s ON d <= eps GROUP BY 1, 2, 3 HAVING count(*) >= least),
links AS (SELECT x.eps, x.least, a, b FROM near JOIN core x ON x.id = a AND d <= x.eps JOIN core y ON y.id = b AND y.eps = x.eps AND y.least = x.least),
reach AS (SELECT * FROM links UNION SELECT r.eps, r.least, r.a, l.b FROM reach r JOIN links l ON l.eps = r.eps AND l.least = r.least AND r.b = l.a),
comp AS (SELECT eps, least, a AS id, min(b) AS cluster FROM reach GROUP BY 1, 2, 3),
border AS (SELECT c.eps, c.least, a AS id, arg_min(c.cluster, struct_pack(d := d, b := b)) AS cluster FROM near JOIN comp c ON c.id = b AND d <= c.eps
  WHERE NOT EXISTS (FROM comp o WHERE o.eps = c.eps AND o.least = c.least AND o.id = a) GROUP BY 1, 2, 3)
SELECT CAST(eps AS DOUBLE) AS eps, CAST(least AS INTEGER) AS min_samples, id AS row_id, cluster, is_core
FROM (SELECT *, 1 AS is_core FROM comp UNION ALL SELECT *, 0 FROM border)""")
def density_settings(spark, sf_dir):
    """Clusters of six settings from one pass over the distances; rows in no cluster of a setting are noise there."""
    vectors = vector_view(spark, sf_dir)
    _, labels = grid.density_grid(vectors, [1.05, 1.1, 1.15], [3, 5])
    return grid.rows_by_setting(vectors, labels)


@query("U9", _density() + """SELECT cluster, count(*) AS size, round(count(*) / (SELECT count(*) FROM clusters), 6) AS share,
CASE WHEN cluster = -1 THEN 1 ELSE 0 END AS is_noise FROM clusters GROUP BY cluster""")
def density_cluster_sizes(spark, sf_dir):
    return round_doubles(an.cluster_info(db.dbscan(vector_view(spark, sf_dir), EPS, MIN_SAMPLES), score=None))


@query("U5 U6 J3 J4", _density("label < 5") + f""", n AS (SELECT v.row_id, arg_min(t.row_id, struct_pack(d := list_distance(v.features, t.features), i := t.row_id)) AS m,
min(list_distance(v.features, t.features)) AS score FROM vectors v, t GROUP BY 1)
SELECT n.row_id, round(score, 6) AS score, cluster, CASE WHEN cluster = -1 OR score > {EPS} THEN 1 ELSE 0 END AS flag
FROM n JOIN clusters ON clusters.row_id = n.m""")
def density_flags(spark, sf_dir):
    """Clusters of the normal groups; every row flagged by its nearest fitted row."""
    vectors = vector_view(spark, sf_dir)
    detector = db.DbscanDetector(EPS, MIN_SAMPLES).fit(vectors.filter("label < 5"))
    return round_doubles(detector.predict(vectors).select("row_id", "score", "cluster", "flag"))


@query("U4 J6 Z7")
def density_label_transfer(spark, sf_dir):
    """Clusters of a sample; the other rows take the label of their nearest sampled row."""
    return db.DbscanDetector(EPS, MIN_SAMPLES, sample_size=200).fit(vector_view(spark, sf_dir)).fitted.select("row_id", "cluster")


def _numbers(spark, sf_dir):
    calls = syscall_view(spark, sf_dir)
    return calls.select("row_id", "eventName", "sus", "evil", F.array("value", F.col("k").cast("double")).alias("features"))


_PARTS = """, g AS (SELECT eventName AS e, count(*) / (SELECT count(*) FROM syscalls) AS w, avg(value) AS m1, avg(k) AS m2,
var_pop(value) AS v1, var_pop(k) AS v2 FROM syscalls GROUP BY 1),
logs AS (SELECT row_id, e, ln(w) - 0.5 * (ln(2 * pi() * v1) + (value - m1) ** 2 / v1 + ln(2 * pi() * v2) + (k - m2) ** 2 / v2) AS l FROM syscalls, g) """


def _group_mixture(df):
    """A diagonal mixture whose components are the event groups."""
    x = F.col("features")
    rows = df.groupBy("eventName").agg(
        F.count("*").alias("n"), F.avg(x[0]).alias("m0"), F.avg(x[1]).alias("m1"), F.var_pop(x[0]).alias("v0"), F.var_pop(x[1]).alias("v1")
    ).orderBy("eventName").collect()
    n = np.array([r["n"] for r in rows], dtype=float)
    return an.Mixture("diag", n / n.sum(), np.array([[r["m0"], r["m1"]] for r in rows]), np.array([[r["v0"], r["v1"]] for r in rows]))


@query("U7", WE + _PARTS + "SELECT row_id, round(-ln(sum(exp(l))), 6) AS score FROM logs GROUP BY row_id")
def mixture_scores(spark, sf_dir):
    df = _numbers(spark, sf_dir)
    return round_doubles(an.mixture_scores(df, _group_mixture(df)).select("row_id", "score"))


@query("U8", WE + _PARTS + """, p AS (SELECT row_id, e, exp(l) / sum(exp(l)) OVER (PARTITION BY row_id) AS p FROM logs)
SELECT row_id, round(max(p), 6) AS best, round(sum(p), 6) AS total FROM p GROUP BY row_id""")
def mixture_posteriors(spark, sf_dir):
    df = _numbers(spark, sf_dir)
    p = F.col("probabilities")
    return round_doubles(an.mixture_scores(df, _group_mixture(df)).select(
        "row_id", F.array_max(p).alias("best"), F.aggregate(p, F.lit(0.0), lambda a, x: a + x).alias("total")))


@query("U14", WV + """, n AS (SELECT label, count(*) AS n FROM vectors GROUP BY 1),
d AS (SELECT a.row_id, a.label, b.label AS other, sum(list_distance(a.features, b.features)) AS s FROM vectors a, vectors b GROUP BY 1, 2, 3),
m AS (SELECT row_id, d.label, max(CASE WHEN other = d.label THEN s / (n - 1) END) AS a, min(CASE WHEN other <> d.label THEN s / n END) AS b
  FROM d JOIN n ON n.label = other GROUP BY 1, 2)
SELECT row_id, CAST(label AS BIGINT) AS label, round((b - a) / greatest(a, b), 6) AS silhouette FROM m""")
def silhouette_samples(spark, sf_dir):
    return round_doubles(an.silhouette(vector_view(spark, sf_dir), "label"))


@query("U14", WV + """, n AS (SELECT label, count(*) AS n FROM vectors GROUP BY 1),
d AS (SELECT a.row_id, a.label, b.label AS other, sum(list_cosine_distance(a.features, b.features)) AS s FROM vectors a, vectors b GROUP BY 1, 2, 3),
m AS (SELECT row_id, d.label, max(CASE WHEN other = d.label THEN s / (n - 1) END) AS a, min(CASE WHEN other <> d.label THEN s / n END) AS b
  FROM d JOIN n ON n.label = other GROUP BY 1, 2), v AS (SELECT label, (b - a) / greatest(a, b) AS v FROM m)
SELECT CAST(label AS BIGINT) AS label, count(*) AS size, round(avg(v), 6) AS mean, round(min(v), 6) AS min, round(max(v), 6) AS max FROM v GROUP BY label""")
def silhouette_by_cluster(spark, sf_dir):
    """Cosine silhouettes summed up per cluster."""
    return round_doubles(an.silhouette_by_cluster(an.silhouette(vector_view(spark, sf_dir), "label", "cosine"), "label"))


@query("U13", WV + _CENTRES + """, names AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT label FROM vectors)),
ids AS (SELECT row_id, unnest(features) AS x, unnest(c) AS y FROM vectors JOIN names USING (label) JOIN centres USING (cluster)),
r AS (SELECT row_id, sum((x - y) ** 2) AS e, sum(abs(x - y)) AS m, 1 - sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y)) + 1e-10) AS c FROM ids GROUP BY 1)
SELECT 'euclidean' AS metric, round(sum(e), 5) AS inertia FROM r UNION ALL SELECT 'manhattan', round(sum(m * m), 5) FROM r UNION ALL SELECT 'cosine', round(sum(c * c), 5) FROM r""")
def inertia_by_metric(spark, sf_dir):
    return round_doubles(an.inertia_by_metric(vector_view(spark, sf_dir), "label", ["euclidean", "manhattan", "cosine"]), 5)


@query("U11", WE + """, l AS (SELECT 'value' AS model, sus, evil, value AS s, CASE WHEN value > 20 THEN 1 ELSE 0 END AS f FROM syscalls
UNION ALL SELECT 'k', sus, evil, CAST(k AS DOUBLE), CASE WHEN k > 90 THEN 1 ELSE 0 END FROM syscalls)
SELECT model, round(count(*) FILTER (sus = 1 AND f = 1) / count(*) FILTER (sus = 1), 6) AS sus_detection_rate,
round(count(*) FILTER (evil = 1 AND f = 1) / count(*) FILTER (evil = 1), 6) AS evil_detection_rate,
round(avg(s) FILTER (sus = 0 AND evil = 0), 6) AS avg_score_normal, round(avg(s) FILTER (sus = 1 AND evil = 0), 6) AS avg_score_sus,
round(avg(s) FILTER (evil = 1), 6) AS avg_score_evil FROM l GROUP BY model""")
def sus_versus_evil(spark, sf_dir):
    calls = syscall_view(spark, sf_dir).select(
        "sus", "evil", F.col("value").alias("value_score"), (F.col("value") > 20).cast("int").alias("value_flag"),
        F.col("k").cast("double").alias("k_score"), (F.col("k") > 90).cast("int").alias("k_flag"))
    return round_doubles(an.sus_versus_evil(calls, ["value", "k"]))


@query("U1 U9")
def kmeans_anomalies(spark, sf_dir):
    """Fitted centres: flagged rows and mean score per cluster."""
    vectors = vector_view(spark, sf_dir)
    flagged = an.KMeansDetector(k=8).fit(vectors).predict(vectors)
    return flagged.groupBy("cluster").agg(F.count("*").alias("rows"), F.sum("flag").alias("flagged"), F.avg("score").alias("mean_score"))


@query("U7 U9")
def mixture_anomalies(spark, sf_dir):
    """A diagonal mixture fitted to whole syscall records."""
    df = _numbers(spark, sf_dir)
    flagged = an.MixtureDetector(k=3, kind="diag").fit(df).predict(df)
    return flagged.groupBy("cluster").agg(F.count("*").alias("rows"), F.sum("flag").alias("flagged"), F.avg("score").alias("mean_score"))


@query("U10 U11 E13 S11")
def detector_comparison(spark, sf_dir):
    """Three detectors fitted on normal rows; all rows scored; rates on suspicious and evil rows."""
    df = vector_view(spark, sf_dir).withColumn("sus", (F.col("label") >= 7).cast("int")).withColumn("evil", (F.col("label") == 9).cast("int"))
    detectors = an.fit_detectors(df, normal_only="sus", dbscan={"eps": EPS, "min_samples": MIN_SAMPLES}, gmm={"k": 3, "kind": "diag"})
    return an.sus_versus_evil(an.score_all(detectors, df), list(detectors))


@query("U15")
def principal_components(spark, sf_dir):
    projected, _ = an.principal_components(vector_view(spark, sf_dir), 2)
    return projected.select("row_id", F.abs(F.col("components")[0]).alias("pc1"), F.abs(F.col("components")[1]).alias("pc2"))
