"""Radial kernel features and the perceptron against numpy."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from tallyloom.operators import kernels


def test_fourier_features_come_near_the_kernel(spark):
    points = np.random.default_rng(1).random((30, 2))
    frame = spark.createDataFrame([(float(a), float(b)) for a, b in points] + [(None, 1.0)], "a double, b double")
    made = kernels.RandomFourier(["a", "b"], 1.5, 3000, 3).transform(frame)
    assert made.filter("features IS NULL").count() == 1
    v = np.array([r["v"] for r in made.filter("features IS NOT NULL").select(vector_to_array("features").alias("v")).collect()])
    exact = np.exp(-1.5 * ((points[:, None] - points[None]) ** 2).sum(axis=2))
    assert np.abs(v @ v.T - exact).max() < 0.12


def test_slope_of_the_perceptron():
    network = kernels.Perceptron([3, 4, 2, 1])
    random = np.random.default_rng(2)
    flat, rows, target = network.start(5), random.normal(size=(9, 3)), random.normal(size=9)
    step = 1e-6

    def loss(w):
        return 0.5 * ((network.predict(w, rows) - target) ** 2).mean()

    by_steps = [(loss(flat + step * e) - loss(flat - step * e)) / (2 * step) for e in np.eye(network.length)]
    assert np.allclose(network.slope(flat, rows, target), by_steps, atol=1e-7)


def test_perceptron_learns_and_predicts_as_numpy(spark):
    points = np.random.default_rng(3).uniform(-1, 1, (3000, 2))
    rows = [(float(a), float(b), float(a * b)) for a, b in points]
    frame = spark.createDataFrame(rows + [(None, 0.0, 1.0), (0.0, float("nan"), 1.0), (0.0, 0.0, None)], "a double, b double, y double").repartition(3)
    model = kernels.PerceptronRegressor(["a", "b"], "y", [12], rounds=10, out="p").fit(frame)
    found = model.transform(frame).collect()
    whole = [r for r in found if r["a"] is not None and r["b"] == r["b"]]
    assert len(found) - len(whole) == 2 and all(r["p"] is None for r in found if r not in whole)
    inputs = (np.array([(r["a"], r["b"]) for r in whole]) - model.means[:-1]) / model.spreads[:-1]
    want = model.network.predict(model.flat, inputs) * model.spreads[-1] + model.means[-1]
    assert np.allclose([r["p"] for r in whole], want)
    wrong = np.array([r["p"] - r["a"] * r["b"] for r in whole])
    assert (wrong ** 2).mean() < 0.1 * np.var(points[:, 0] * points[:, 1])


def test_perceptron_without_rows(spark):
    with pytest.raises(ValueError, match="no training rows"):
        kernels.PerceptronRegressor(["a"], "y").fit(spark.createDataFrame([], "a double, y double"))


def ring(spark, rows):
    points = np.random.default_rng(7).random((rows, 2)) * 2 - 1
    return spark.createDataFrame([(k, float(a), float(b), float(a * a + b * b < 0.6)) for k, (a, b) in enumerate(points)], "k int, a double, b double, label double")


def test_radial_machine_stores_no_features(spark, monkeypatch):
    """Training makes the features pass by pass; the result is as good as MLlib's machine over stored ones."""
    frame = ring(spark, 600)
    waves = kernels.RandomFourier(["a", "b"], 2.0, 60, 5)
    stored = waves.transform(frame)
    machine = kernels.linear_svm(10.0, 600, maxIter=60).fit(stored)
    with monkeypatch.context() as patch:
        patch.setattr(kernels.RandomFourier, "_transform", lambda *_: pytest.fail("features of all training rows were made"))
        model = kernels.rbf_svm(["a", "b"], 2.0, 10.0, 600, width=60, seed=5, maxIter=60).fit(frame)
    made = np.array([r["v"] for r in stored.orderBy("k").select(vector_to_array("features").alias("v")).collect()])
    side = np.array([2 * r["label"] - 1 for r in frame.orderBy("k").collect()])
    spread = made.std(axis=0, ddof=1)

    def cost(weights, intercept):
        return np.maximum(0, 1 - side * (made @ weights + intercept)).mean() + ((weights * spread) ** 2).sum() / (2 * 600 * 10.0)

    mine = model.stages[0]
    assert cost(mine.weights, mine.intercept) <= 1.02 * cost(machine.coefficients.toArray(), machine.intercept)
    got = model.transform(frame).orderBy("k").select("prediction", vector_to_array("rawPrediction").alias("raw")).collect()
    far = made @ mine.weights + mine.intercept
    assert np.allclose([r["raw"] for r in got], np.column_stack([-far, far]), atol=1e-3)
    assert [r["prediction"] for r in got] == [float(r["raw"][1] > 0) for r in got]


def test_radial_machine_and_odd_rows(spark):
    frame = ring(spark, 80)
    model = kernels.rbf_svm(["a", "b"], 2.0, 10.0, 80, width=20, maxIter=5).fit(frame)
    odd = spark.createDataFrame([(None, 1.0), (1.0, None), (0.0, 0.0)], "a double, b double")
    assert [r["prediction"] for r in model.transform(odd).collect()][:2] == [None, None]
    assert model.transform(odd.limit(0)).count() == 0
    for bad in ("CAST(NULL AS double)", "CAST('NaN' AS double)"):
        with pytest.raises(ValueError, match="80 training rows, 80 with null or NaN"):
            kernels.rbf_svm(["a", "b"], 2.0, 10.0, 80).fit(frame.selectExpr("a", f"{bad} AS b", "label"))
    with pytest.raises(ValueError, match="0 training rows"):
        kernels.rbf_svm(["a", "b"], 2.0, 10.0, 80).fit(frame.limit(0))


def test_wide_angles_are_turned_back():
    rows, shifts, directions = np.array([[1e6, -3e5]]), np.array([0.5, 1.0]), np.array([[1.0, 2.0], [0.3, -0.7]])
    assert np.allclose(kernels._waves(rows, shifts, directions), np.cos(rows @ directions.T + shifts), atol=1e-6)
    assert kernels._waves(np.zeros((0, 2)), shifts, directions).shape == (0, 2)
