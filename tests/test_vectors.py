"""Neighbours, clusters, silhouettes and mixtures against brute force in NumPy."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from secflow.operators import anomaly, dbscan, neighbors, two_stage

RNG = np.random.default_rng(7)


def frame(spark, points, extra=None):
    rows = [(i, [float(v) for v in p], int(extra[i]) if extra is not None else 0) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "row_id long, features array<double>, label int")


def distances(a, b, metric):
    if metric == "euclidean":
        return np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
    if metric == "manhattan":
        return np.abs(a[:, None] - b[None]).sum(2)
    return 1 - (a @ b.T) / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None])


def brute_dbscan(x, eps, least):
    near = distances(x, x, "euclidean") <= eps
    core = near.sum(1) >= least
    label = np.full(len(x), -1)
    number = 0
    for i in np.nonzero(core)[0]:
        if label[i] >= 0:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if label[j] >= 0:
                continue
            label[j] = number
            stack += [n for n in np.nonzero(near[j] & core)[0] if label[n] < 0]
        number += 1
    return core, label


def blobs():
    points = np.vstack([RNG.normal(0, 0.3, (60, 3)), RNG.normal(4, 0.3, (60, 3)), RNG.uniform(-3, 8, (15, 3))])
    return np.vstack([points, np.repeat(points[:1], 70, axis=0)])  # a third of the rows are copies


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
def test_nearest_is_exact(spark, metric):
    x = blobs()
    df = frame(spark, x)
    got = neighbors.nearest(df, df, 3, metric, exclude_self=True, block_rows=32).collect()
    d = distances(x, x, metric)
    np.fill_diagonal(d, np.inf)
    assert len(got) == 3 * len(x)
    for r in got:
        assert r["distance"] == pytest.approx(np.sort(d[r["row_id"]])[r["rank"] - 1], abs=1e-7)
        assert r["neighbor"] != r["row_id"]


def test_pairs_within_radius(spark):
    x = RNG.normal(0, 1, (80, 2))
    got = {(r["left"], r["right"]) for r in neighbors.pairs_within(frame(spark, x), 0.4, block_rows=16).collect()}
    d = distances(x, x, "euclidean")
    assert got == {(i, j) for i in range(80) for j in range(i + 1, 80) if d[i, j] <= 0.4}


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "cosine"])
def test_pairs_within_radius_lists_copies(spark, metric):
    x = np.vstack([RNG.normal(3, 1, (40, 2)), RNG.normal(3, 1, (5, 2)).repeat(12, axis=0)])
    radius = 0.4 if metric != "cosine" else 0.01
    got = [(r["left"], r["right"]) for r in neighbors.pairs_within(frame(spark, x), radius, metric, block_rows=8).collect()]
    d = distances(x, x, metric)
    assert sorted(got) == [(i, j) for i in range(100) for j in range(i + 1, 100) if d[i, j] <= radius]


def test_close_pairs_with_copies_equal_sql(spark, tmp_path):
    """The registered query on a table of embeddings with repeated vectors, against its SQL twin."""
    from secflow.plans import load_all

    embeddings = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    copies = embeddings.filter("vec_id % 5 = 0").selectExpr("vec_id + 100000 AS vec_id", "embedding", "label")
    few = embeddings.filter("vec_id % 50 = 1").withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(30)))).selectExpr("200000 + 1000 * vec_id + n AS vec_id", "embedding", "label")
    made = embeddings.unionByName(copies).unionByName(few)
    made.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    entry = load_all()["close_pairs"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(f"SELECT \"left\", \"right\", distance FROM ({entry.sql})").fetchall()
    got = [(r["left"], r["right"], r["distance"]) for r in entry.plan(spark, str(tmp_path)).collect()]
    assert {(a, b) for a, b, _ in got} == {(a, b) for a, b, _ in want} and len(got) == len(want)
    assert [d for *_, d in sorted(got)] == pytest.approx([d for *_, d in sorted(want)], abs=2e-6)


def test_dbscan_matches_brute_force(spark):
    x = blobs()
    core, label = brute_dbscan(x, 0.5, 5)
    rows = dbscan.dbscan(frame(spark, x), 0.5, 5, block_rows=24).collect()
    got = {r["row_id"]: (r["cluster"], r["is_core"]) for r in rows}
    assert [got[i][1] for i in range(len(x))] == core.astype(int).tolist()
    names = {}
    for i in np.nonzero(core)[0]:
        assert names.setdefault(label[i], got[i][0]) == got[i][0]
    assert len(set(names.values())) == len(names)
    d = distances(x, x, "euclidean")
    for i in np.nonzero(~core)[0]:
        reach = np.nonzero(core & (d[i] <= 0.5))[0]
        if len(reach):
            assert got[i][0] in {names[label[j]] for j in reach}
        else:
            assert got[i][0] == -1


def test_point_exactly_at_eps_and_no_core(spark):
    df = frame(spark, [[0.0], [1.0], [2.0], [9.0]])
    rows = {r["row_id"]: r["cluster"] for r in dbscan.dbscan(df, 1.0, 3).collect()}
    assert rows == {0: 0, 1: 0, 2: 0, 3: -1}
    assert {r["cluster"] for r in dbscan.dbscan(df, 1.0, 9).collect()} == {-1}


def test_sample_fit_labels_every_row(spark):
    df = frame(spark, blobs())
    fitted = dbscan.DbscanDetector(0.6, 4, sample_size=120).fit(df).fitted
    assert fitted.count() == df.count() == fitted.select("row_id").distinct().count()


def test_silhouette_matches_definition(spark):
    x = np.vstack([blobs()[:100], [[50.0, 50, 50]]])
    groups = np.r_[np.arange(100) % 3, [7]]
    got = {r["row_id"]: r["silhouette"] for r in anomaly.silhouette(frame(spark, x, groups), "label", block_rows=16).collect()}
    d = distances(x, x, "euclidean")
    for i in range(len(x)):
        same = groups == groups[i]
        if same.sum() == 1:
            assert got[i] == 0
            continue
        a = d[i][same].sum() / (same.sum() - 1)
        b = min(d[i][groups == g].mean() for g in set(groups) - {groups[i]})
        assert got[i] == pytest.approx((b - a) / max(a, b), abs=1e-9)


@pytest.mark.parametrize("kind", ["full", "tied", "diag", "spherical"])
def test_mixture_finds_two_groups(spark, kind):
    x = np.vstack([RNG.normal(0, 1, (150, 2)), RNG.normal(8, 1, (50, 2))])
    m = anomaly.fit_mixture(frame(spark, x), 2, kind, start=np.array([[1.0, 1.0], [7.0, 7.0]]))
    assert sorted(m.weights) == pytest.approx([0.25, 0.75], abs=0.02)
    assert np.sort(m.means[:, 0]) == pytest.approx([0, 8], abs=0.5)
    assert m.bic() > m.aic()
    total = anomaly.mixture_scores(frame(spark, x), m).agg(F.sum(-F.col("score"))).head()[0]
    assert total == pytest.approx(m.log_likelihood, rel=1e-3)


def test_oversampling_balances_and_stays_on_segments(spark):
    x = np.vstack([RNG.normal(0, 1, (40, 2)), [[5.0, 5.0], [6.0, 7.0]], [[-4.0, 2.0]]])
    label = np.r_[np.zeros(40), [1, 1], [2]]
    out = two_stage.oversample(frame(spark, x, label), "label", k=3).collect()
    assert [sum(r["label"] == c for r in out) for c in (0, 1, 2)] == [40, 40, 40]
    for r in out:
        if r["label"] == 1:
            t = (r["features"][0] - 5) / 1
            assert -1e-9 <= t <= 1 + 1e-9 and r["features"][1] == pytest.approx(5 + 2 * t)
        if r["label"] == 2:
            assert r["features"] == [-4.0, 2.0]


def test_mixtures_side_by_side_equal_single_fits(spark):
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(size=(60, 2)), rng.normal(size=(40, 2)) * 2 + 9, [[500.0, 500.0]]]
    df = frame(spark, x)
    settings = [(2, "full"), (2, "tied"), (3, "diag"), (3, "spherical")]
    together = anomaly.fit_mixtures(df, settings)
    for (k, kind), m in zip(settings, together):
        alone = anomaly.fit_mixture(df, k, kind)
        assert np.allclose(alone.means, m.means) and np.allclose(alone.covariances, m.covariances)
        assert alone.log_likelihood == pytest.approx(m.log_likelihood) and (alone.converged, alone.rows) == (m.converged, m.rows)
    for m, value in zip(together, anomaly.mixture_silhouettes(df, together)):
        assert value == pytest.approx(anomaly.linear_silhouette(anomaly.mixture_scores(df, m), "cluster"))
    lonely = anomaly.Mixture("diag", np.array([1.0, 0.0]), np.zeros((2, 2)), np.ones((2, 2)))
    assert anomaly.mixture_silhouettes(df, [lonely]) == [None]


def test_the_anomaly_pipeline_clusters_every_row(spark, monkeypatch):
    from secflow.plans import pipelines

    table = frame(spark, [(i % 5 * 0.5, i % 10 * 0.5) for i in range(60)]).select(
        "row_id", F.col("row_id").cast("double").alias("x"), array_to_vector("features").alias("features"),
        (F.col("row_id") % 7 == 0).cast("int").alias("sus"), F.lit(0).alias("evil"), F.when(F.col("row_id") % 3 == 0, "test").otherwise("train").alias("split"))
    monkeypatch.setattr(pipelines, "syscall_view", lambda spark, sf_dir: table)
    monkeypatch.setattr(pipelines.loading, "prepare_syscalls", lambda raw: raw.drop("features"))
    monkeypatch.setattr(pipelines.loading, "prepare_syscall_vectors", lambda raw: raw.drop("x"))
    seen = []
    monkeypatch.setattr(pipelines.an, "fit_detectors", lambda df, normal_only, **options: seen.append((df.count(), options["dbscan"])) or {})
    monkeypatch.setattr(pipelines.an, "score_all", lambda detectors, df: df)
    monkeypatch.setattr(pipelines.an, "sus_versus_evil", lambda df, names: df.select("row_id"))
    assert pipelines.anomaly_pipeline(spark, "").count() == 40
    monkeypatch.setattr(dbscan, "sample_rows", None)
    for rows, options in seen:
        assert rows == 40 and dbscan.DbscanDetector(**options).fit(table).fitted.count() == 60
    assert len(seen) == 2
