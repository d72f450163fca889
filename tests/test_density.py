"""Density clusters of whole vectors against brute force."""

import numpy as np
import pytest
from test_clusters import brute_dbscan

from tallyloom.operators import density


def clusters(spark, rows, eps, least, **how):
    frame = spark.createDataFrame(rows, "id bigint, v array<double>, cluster string")
    return {r["id"]: (r["cluster"], r["kind"]) for r in density.dbscan_vectors(frame, "id", "v", eps, least, **how).collect()}


@pytest.mark.parametrize("dims, eps", [(1, 0.002), (3, 0.09), (8, 0.45)])
def test_dbscan_of_vectors(spark, dims, eps):
    """A crowd of near copies, exact copies and scattered rows, met in small blocks."""
    rng = np.random.default_rng(dims)
    points = np.vstack([rng.normal(0.5, eps / 20, (150, dims)), np.tile(rng.random(dims), (40, 1)), rng.random((400, dims))])
    label, kind = brute_dbscan(points, eps, 4)
    rows = [(i, p.tolist(), "x") for i, p in enumerate(points)]
    got = clusters(spark, rows, eps, 4, pivots=9, block_rows=70)
    assert [got[i] for i in range(len(points))] == list(zip(label.tolist(), kind.tolist()))
    assert len(set(kind)) == 3


def test_dbscan_of_odd_rows(spark):
    rows = [(1, None, "x"), (2, [0.0, None], "x"), (3, [0.0, float("nan")], "x"), (4, [], "x"), (5, [0.0, 0.0], "x"), (6, [0.0, 0.0], "x"), (7, [0.0, 1.0], "x"), (8, [9.0, 9.0], "x")]
    noise = (-1, "noise")
    assert clusters(spark, rows, 1.0, 3) == {1: noise, 2: noise, 3: noise, 4: noise, 5: (5, "core"), 6: (5, "core"), 7: (5, "core"), 8: noise}
    assert clusters(spark, rows, 1.0, 4) == {k: noise for k in range(1, 9)}
    assert clusters(spark, rows[:4], 1.0, 1) == {k: noise for k in range(1, 5)} and clusters(spark, [], 1.0, 1) == {}


def test_border_row_takes_the_lowest_cluster(spark):
    left, right = [[0.0], [0.1], [0.2]], [[2.2], [2.3], [2.4]]
    rows = [(k, v, "x") for k, v in enumerate([*right, *left, [1.2]])]
    got = clusters(spark, rows, 1.0, 4, pivots=2, block_rows=2)
    assert got[6][1] in ("border", "core") and got == clusters(spark, rows, 1.0, 4)
    label, kind = brute_dbscan(np.array([v for _, v, _ in rows]), 1.0, 4)
    assert [got[k] for k in range(7)] == list(zip(label.tolist(), kind.tolist()))


def test_near_decides_close_calls_exactly():
    a, b = np.array([[1e6, 0.1]]), np.array([[1e6, 0.4], [1e6, 0.1 + 0.3 + 1e-9]])
    exact = ((a[0] - b) ** 2).sum(axis=1) <= 0.3 * 0.3
    assert density.within(a, b, 0.3)[0].tolist() == exact.tolist()


@pytest.mark.parametrize("shift, scale", [(0.0, 1.0), (1e7, 1.0), (0.0, 1e-25), (0.0, 1e30)])
def test_reach_says_what_differences_say(shift, scale):
    """Single precision decides no close call, far from the origin, for tiny and for huge numbers."""
    rng = np.random.default_rng(41)
    homes = (rng.random((90, 6)) + shift) * scale
    others = np.vstack([homes[:30] + 0.5 * scale, (rng.random((200, 6)) + shift) * scale])
    eps = float(np.sqrt(((homes[3] - others[3]) ** 2).sum()))
    want = ((homes[:, None, :] - others[None, :, :]) ** 2).sum(axis=2) <= eps * eps
    near = density._Reach(homes, eps).of(others)
    rows, columns = np.arange(5, 90), np.arange(0, 230, 3)
    assert (near(np.arange(90), np.arange(230)) == want).all() and (near(rows, columns) == want[rows][:, columns]).all()


def test_wide_radius_deals_a_row_to_few_blocks(spark, monkeypatch):
    """Where every cell is met by all rows, a row travels once a block and not once a pivot."""
    rng, seen, met = np.random.default_rng(42), [], density._met

    def watched(*args):
        seen.append(next(x for x in args if isinstance(x, dict)))
        return met(*args)

    monkeypatch.setattr(density, "_met", watched)
    points = rng.normal(0, 1, (1_500, 8))
    got = clusters(spark, [(i, p.tolist(), "x") for i, p in enumerate(points)], 2.2, 5)
    label, kind = brute_dbscan(points, 2.2, 5)
    assert [got[i] for i in range(len(points))] == list(zip(label.tolist(), kind.tolist()))
    assert len(seen) == 2 and all(sum(every for _, every in sizes.values()) <= 8 * len(points) for sizes in seen)
