"""Neighbours, density clusters and components against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import clustering, neighbours, pairs
from tallyloom.plans.graph import connected_components


def brute_dbscan(points, eps, least):
    d2 = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    near = d2 <= eps * eps
    core = near.sum(axis=1) >= least
    label = np.full(len(points), -1)
    for i in np.flatnonzero(core):
        if label[i] >= 0:
            continue
        stack, label[i] = [i], i
        while stack:
            for j in np.flatnonzero(near[stack.pop()] & core):
                if label[j] < 0:
                    label[j] = i
                    stack.append(j)
    kind = np.where(core, "core", "noise").astype(object)
    for i in np.flatnonzero(~core):
        close = label[near[i] & core]
        if len(close):
            label[i], kind[i] = close.min(), "border"
    return label, kind


def check_dbscan(spark, points, eps, least):
    frame = pd.DataFrame({"id": np.arange(len(points)), "x": points[:, 0], "y": points[:, 1]})
    got = clustering.dbscan(spark.createDataFrame(frame), "id", "x", "y", eps, least).toPandas().sort_values("id")
    label, kind = brute_dbscan(points, eps, least)
    assert got["kind"].tolist() == kind.tolist()
    assert got["cluster"].tolist() == label.tolist()


def test_dbscan_with_a_hot_cell(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal([0.5, 0.5], 0.002, (500, 2))
    check_dbscan(spark, np.vstack([hot, rng.random((700, 2))]), 0.035, 5)


@pytest.mark.parametrize("gap", [0.0999, 0.1001])
def test_dbscan_cells_that_nearly_touch(spark, gap):
    """Two crowded cells whose nearest points decide; boxes must be refined."""
    rng = np.random.default_rng(4)
    left = np.column_stack([-rng.random(200) * 0.06, rng.random(200) * 0.06])
    right = np.column_stack([gap + rng.random(200) * 0.06, rng.random(200) * 0.06])
    left[0], right[0] = (0.0, 0.03), (gap, 0.03)
    check_dbscan(spark, np.vstack([left, right]), 0.1, 4)


def test_knn_join_in_small_blocks(spark):
    rng = np.random.default_rng(8)
    points = np.vstack([np.tile([0.2, 0.2, 0.2], (60, 1)), rng.random((240, 3))])
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id bigint, v array<double>")
    got = neighbours.knn_join(frame, frame, "id", "id", "v", 4, exclude_self=True, pivots=6, block_rows=25).toPandas()
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1, kind="stable")[:, :4]
    have = got.sort_values(["id", "rank"]).groupby("id")["neighbour"].apply(list)
    assert len(have) == len(points)
    assert [have[i] for i in range(len(points))] == want.tolist()


@pytest.mark.parametrize("pivots, block_rows", [(1, 10_000), (6, 25), (16, 90), (40, 7)])
def test_knn_join_by_any_packing(spark, pivots, block_rows):
    """Far from the origin products round much; near copies, equal rows and unusable vectors are among them."""
    rng = np.random.default_rng(21)
    points = rng.normal(0, 1, (160, 5)) + 1e4
    points[40:60] = points[40]
    points[60:80] = points[40] + rng.normal(0, 1e-6, (20, 5))
    odd = [(1000, None), (1001, [1.0, None, 1.0, 1.0, 1.0]), (1002, [float("nan")] * 5), (1003, [float("inf")] + [0.0] * 4)]
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)] + odd, "id bigint, v array<double>")
    got = neighbours.knn_join(frame, frame, "id", "id", "v", 3, exclude_self=True, pivots=pivots, block_rows=block_rows).toPandas()
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1, kind="stable")[:, :3]
    got = got.sort_values(["id", "rank"])
    assert got["neighbour"].to_numpy().reshape(-1, 3).tolist() == want.tolist()
    assert np.allclose(got["distance"].to_numpy().reshape(-1, 3), np.take_along_axis(d, want, axis=1), rtol=1e-12, atol=0)


def test_few_references(spark):
    refs = spark.createDataFrame([(7, [0.0]), (8, [5.0])], "r bigint, v array<float>")
    asks = spark.createDataFrame([(1, [1.0]), (2, [9.0]), (3, None)], "q bigint, v array<float>")
    got = neighbours.knn_join(asks, refs, "q", "r", "v", 4).orderBy("q", "rank").collect()
    assert [(r["q"], r["neighbour"], r["distance"], r["rank"]) for r in got] == [(1, 7, 1.0, 1), (1, 8, 4.0, 2), (2, 8, 4.0, 1), (2, 7, 9.0, 2)]
    assert neighbours.knn_join(asks.limit(0), refs, "q", "r", "v", 4).count() == 0
    assert neighbours.knn_join(asks, refs.limit(0), "q", "r", "v", 4).count() == 0


def test_distances_of_near_copies_far_out():
    rng = np.random.default_rng(22)
    a = rng.normal(0, 1, (50, 8)) + 1e5
    b = np.vstack([a[:20], a[20:40] + 1e-5, rng.normal(0, 1, (30, 8))])
    want = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    assert np.allclose(pairs.distances(a, b), want, rtol=1e-9, atol=0)


def test_vectors_of_several_lengths_are_refused():
    import pyarrow as pa

    with pytest.raises(ValueError, match="vectors of 2 and 4 numbers"):
        pairs.matrix(pa.array([[1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]))


@pytest.mark.parametrize("block_rows", [13, 4_000])
def test_euclidean_silhouette_matches_pairs(spark, block_rows):
    rng = np.random.default_rng(23)
    points, k = rng.random((60, 4)), np.arange(60) % 3
    points[10:20], k[59] = points[10], 9
    odd = [(100, None, 1), (101, [0.1] * 4, None), (102, [0.1, None, 0.1, 0.1], 2)]
    frame = spark.createDataFrame([(i, p.tolist(), int(c)) for i, (p, c) in enumerate(zip(points, k))] + odd, "i bigint, v array<double>, k int")
    got = {r["i"]: r["silhouette"] for r in clustering.silhouette_euclidean(frame, "i", "v", "k", block_rows=block_rows).collect()}
    assert len(got) == 63 and all(got[i] is None for i in (100, 101, 102))
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    for i in range(60):
        n = (k == k[i]).sum()
        a = d[i, k == k[i]].sum() / max(1, n - 1)
        b = min(d[i, k == c].mean() for c in np.unique(k) if c != k[i])
        assert got[i] == pytest.approx((b - a) / max(a, b) if n > 1 else 0.0)


def check_components(spark, edges):
    parent = {}

    def root(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()
    want = {n: root(n) for e in edges if e[0] != e[1] for n in e}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_components(spark):
    rng = np.random.default_rng(9)
    check_components(spark, [(i, i + 1) for i in range(0, 60)] + [(100, int(j)) for j in range(101, 140)] + [
        (int(a) + 200, int(b) + 200) for a, b in rng.integers(0, 80, (60, 2))])


def test_components_with_hubs(spark):
    """Hubs of the smallest, the largest and a middle node of their component, two of them joined late."""
    rng = np.random.default_rng(10)
    hubs = [(0, i) for i in range(1, 1501)] + [(9000, i) for i in range(5000, 6500)] + [(20000, int(i)) for i in rng.integers(19000, 23000, 3000)]
    check_components(spark, hubs + [(1400, 30001), (30001, 30000), (30000, 6400)] + [(40000 + i, 40001 + i) for i in range(50)])


def test_smote_balances_classes_on_segments(spark):
    rng = np.random.default_rng(10)
    rows = [(i, int(i % 5 == 0), float(a), float(b)) for i, (a, b) in enumerate(rng.random((203, 2)))]
    df = spark.createDataFrame(rows, "id bigint, y int, a double, b double")
    made = neighbours.smote(df, "id", "y", 1, ["a", "b"], 3, 1).toPandas()
    small = sum(r[1] for r in rows)
    assert len(made) == len(rows) - 2 * small and set(made["y"]) == {1}
    at = {r[0]: np.array(r[2:]) for r in rows if r[1] == 1}
    for r in made.itertuples():
        p, q = at[r.base_id], at[r.neighbour]
        assert np.allclose([r.a, r.b], p + r.share * (q - p))


def test_squared_silhouette_matches_pairs(spark):
    rng = np.random.default_rng(11)
    rows = [(i, p.tolist(), int(i % 3)) for i, p in enumerate(rng.random((60, 4)))]
    df = spark.createDataFrame(rows, "i bigint, v array<double>, k int")
    got = {r["i"]: r["silhouette"] for r in clustering.silhouette_squared(df, "i", "v", "k").collect()}
    points, k = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    d = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    for i in range(60):
        a = d[i, (k == k[i])].sum() / ((k == k[i]).sum() - 1)
        b = min(d[i, k == c].mean() for c in range(3) if c != k[i])
        assert got[i] == pytest.approx((b - a) / max(a, b))


def test_kmeans_inertia_falls(spark):
    rng = np.random.default_rng(12)
    df = spark.createDataFrame([(rng.normal(c, 0.05, 2).tolist(),) for c in (0, 1, 2) for _ in range(40)], "v array<double>")
    found = [r["inertia"] for r in clustering.elbow(df, "v", [1, 2, 3], 1).orderBy("k").collect()]
    assert found[0] > found[1] > found[2] and found[2] < 1.5
    assert df.select(F.size("v")).first()[0] == 2


def test_too_many_clusters_are_refused(spark):
    df = spark.createDataFrame([(i, [float(i)], i % 3) for i in range(9)], "i bigint, v array<double>, k int")
    assert clustering.silhouette_squared(df, "i", "v", "k", most_clusters=3).count() == 9
    with pytest.raises(Exception, match="more than 2 clusters"):
        clustering.silhouette_squared(df, "i", "v", "k", most_clusters=2).collect()
