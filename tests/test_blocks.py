"""Blocks of pairs: what travels grows with the rows, and chunks inside a block change no result."""

import numpy as np
import pytest

from tallyloom.operators import clustering, neighbours, pairs


def copies(rows, numbers):
    """How often all rows travel, when each goes to every block."""
    return rows * -(-rows // pairs.block_size(rows, numbers))


def test_what_travels_grows_with_the_rows():
    assert copies(600_000, 64) <= 6.1 * copies(100_000, 64)
    assert copies(2_000_000, 64) <= 20.1 * copies(100_000, 64)
    assert 8 * 4_096 * pairs.block_size(10**9, 4_096) <= pairs.BLOCK_BYTES
    assert pairs.block_size(0, 0) >= 1 and pairs.block_size(10, 10**9) == 1


@pytest.mark.parametrize("chunk, most", [(7, 40), (3, 1), (64, 10_000)])
def test_nearest_in_chunks(monkeypatch, chunk, most):
    monkeypatch.setattr(pairs, "CHUNK", chunk)
    monkeypatch.setattr(pairs, "PAIRS", most)
    rng = np.random.default_rng(31)
    a = rng.normal(0, 1, (90, 5)) + 1e4
    a[20:50] = a[20]
    a[50:60] = a[20] + rng.normal(0, 1e-7, (10, 5))
    names = rng.permutation(90)
    i, j, d = pairs.nearest(a, a, names, 4, names)
    far = np.sqrt(((a[:, None, :] - a[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(far, np.inf)
    want = np.array([np.lexsort((names, row))[:4] for row in far])
    assert i.tolist() == np.repeat(np.arange(90), 4).tolist() and j.reshape(-1, 4).tolist() == want.tolist()
    assert d.reshape(-1, 4).tolist() == np.take_along_axis(far, want, axis=1).tolist()


def test_floats_travel_as_floats(spark):
    """Vectors of floats are not widened before the blocks meet, and distances are those of doubles."""
    rng = np.random.default_rng(32)
    points = rng.random((120, 6)).astype("float32")
    frame = spark.createDataFrame([(k, p.tolist(), k % 3) for k, p in enumerate(points)], "i bigint, v array<float>, k int")
    found = neighbours.knn_join(frame, frame, "i", "i", "v", 2, exclude_self=True, pivots=5, block_rows=30)
    silhouettes = clustering.silhouette_euclidean(frame, "i", "v", "k", block_rows=30)
    for frame in (found, silhouettes):
        assert "as array<double>" not in frame._jdf.queryExecution().optimizedPlan().toString()
    wide = points.astype("float64")
    far = np.sqrt(((wide[:, None, :] - wide[None, :, :]) ** 2).sum(axis=2))
    got = found.toPandas()
    assert np.allclose(got["distance"], far[got["i"], got["neighbour"]], rtol=1e-12, atol=0)


def test_every_two_blocks_meet_once(spark):
    frame = spark.range(200).selectExpr("id", "array(double(id)) v", "id % 2 k")
    silhouettes = clustering.silhouette_euclidean(frame, "id", "v", "k", block_rows=20)
    plan = silhouettes._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" not in plan and silhouettes.filter("silhouette IS NULL").count() == 0
