"""Block comparisons of many dimensions: one row per visitor, exact distances, forests."""

from __future__ import annotations

import numpy as np

from secflow.functions.geometry import block_distances
from secflow.operators import dbscan, neighbors

RNG = np.random.default_rng(11)


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, features array<double>")


def test_rows_are_not_copied_per_open_cell(spark):
    df = frame(spark, RNG.normal(0, 1, (600, 24)))
    cells, placed = neighbors.build_cells(df, "euclidean", 64)
    parts = neighbors._Parts(cells.count, 64)
    visits = neighbors._visits(df, cells, parts, 8.0, 1)
    assert visits.count() == 600
    assert all(list(r["open"]) == list(range(parts.number)) for r in visits.select("open").distinct().collect())


def test_parts_stay_bounded_and_few():
    assert neighbors.side_parts(100_000, 2048) == neighbors.MOST_PARTS
    assert -(-5_000_000 // neighbors.side_parts(5_000_000, 2048)) <= neighbors.PART_ROWS
    assert neighbors.side_parts(5, 2048) == 1


def test_product_distances_equal_differences():
    a = RNG.normal(100, 1, (70, 20))
    b = np.vstack([a[:10], a[10:20] + 1e-7, RNG.normal(100, 1, (30, 20)), np.zeros((1, 20))])
    want = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
    limit = want[3, 25]
    got = block_distances(a, b, "euclidean", (limit,))
    assert np.allclose(got, want, rtol=1e-9, atol=0)
    assert ((got <= limit) == (want <= limit)).all()
    a[0, 0] = np.nan
    assert np.isnan(block_distances(a, b, "euclidean")[0]).all() and np.isfinite(block_distances(a, b, "euclidean")[1:]).all()


def test_neighbours_and_clusters_of_many_parts(spark):
    x = np.round(RNG.normal(0, 1, (400, 12)), 1)
    x[300:] = x[:100]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    df = frame(spark, x).withColumnRenamed("id", "row_id")
    got = {(r["row_id"], r["rank"]): r["neighbor"] for r in neighbors.nearest(df, df, 2, exclude_self=True, block_rows=16).collect()}
    for i in range(400):
        order = [j for j in np.lexsort((np.arange(400), d[i])) if j != i]
        assert [got[i, 1], got[i, 2]] == order[:2]
    near = {(i, j) for i, j in zip(*np.nonzero(d <= 3.0)) if i < j}
    assert {(r["left"], r["right"]) for r in neighbors.pairs_within(df, 3.0, block_rows=16).collect()} == near
    small = {tuple(r) for r in dbscan.dbscan(df, 3.0, 5, block_rows=16).collect()}
    assert small == {tuple(r) for r in dbscan.dbscan(df, 3.0, 5).collect()}
    assert {i for i, _, core in small if core} == set(np.nonzero((d <= 3.0).sum(1) >= 5)[0])


def test_forest_has_the_lowest_ids():
    a, b = np.array([5, 9, 2, 7, 20]), np.array([9, 7, 5, 30, 20])
    x, y = dbscan.forest(a, b)
    assert dict(zip(x.tolist(), y.tolist())) == {5: 2, 7: 2, 9: 2, 30: 2}
