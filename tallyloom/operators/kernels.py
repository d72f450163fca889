"""Models that need more than a linear map of their columns: radial kernels and perceptrons."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.models import linear_svm
from tallyloom.plans.scratch import materialised
from tallyloom.plans.workers import importable


class RandomFourier(Transformer):
    """A vector whose dot products come near the radial kernel exp(-gamma |a - b|^2) of the columns.

    ``width`` cosines of random directions, drawn from ``seed``; the error falls
    with the root of ``width``. A row with a null column gets a null vector.
    The cosines are a plain expression over a literal table, so no Python runs per row.
    """

    def __init__(self, columns: Sequence[str], gamma: float, width: int = 200, seed: int = 0, out: str = "features"):
        super().__init__()
        random = np.random.default_rng(seed)
        self.columns, self.out = list(columns), out
        self.directions = random.normal(0, np.sqrt(2 * gamma), (width, len(self.columns)))
        self.shifts = random.uniform(0, 2 * np.pi, width)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scale = float(np.sqrt(2 / len(self.shifts)))
        drawn = F.lit(np.column_stack([self.shifts, self.directions]).tolist())  # one array per wave: its shift, then its direction

        def wave(w):
            angle = w[0]
            for k, column in enumerate(self.columns, 1):
                angle = angle + w[k] * F.col(column)
            return F.lit(scale) * F.cos(angle)

        waves = F.transform(drawn, wave)
        known = F.lit(True)
        for column in self.columns:
            known = known & F.col(column).isNotNull()
        return dataset.withColumn(self.out, F.when(known, array_to_vector(waves)))


def rbf_svm(columns: Sequence[str], gamma: float, c: float, rows: int, classes: int = 2, width: int = 200, seed: int = 0, **params) -> Pipeline:
    """Support vector machine with a radial kernel: a linear one over random Fourier features, fitted in passes over the rows.

    With two classes the features are made anew in each pass and never stored.
    """
    waves = RandomFourier(columns, gamma, width, seed)
    if classes == 2 and not set(params) - {"maxIter", "tol", "labelCol"}:
        return Pipeline(stages=[FourierMachine(waves, 1.0 / (rows * c), **params)])
    return Pipeline(stages=[waves, linear_svm(c, rows, classes, **params)])


class FourierMachine(Estimator):
    """Linear support vector machine over random Fourier features, with the objective of MLlib's LinearSVC.

    That is the mean hinge loss and ``penalty`` / 2 times the squared weights
    of the features scaled to unit deviation; the intercept is free. Each
    evaluation is one pass over the stored columns that makes the features of
    a batch, uses and drops them; only sums per weight leave the executors.
    Quasi-Newton steps on the driver have ``width`` + 1 numbers.
    """

    def __init__(self, waves: RandomFourier, penalty: float, maxIter: int = 100, tol: float = 1e-6, labelCol: str = "label"):
        super().__init__()
        self.waves, self.penalty, self.most, self.tol, self.label = waves, penalty, maxIter, tol, labelCol

    def _fit(self, dataset: DataFrame) -> FourierMachineModel:
        importable(dataset.sparkSession)
        numbers = [F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate([*self.waves.columns, self.label])]
        rows = materialised(dataset.select(*numbers), "fourier-rows")
        odd = F.lit(False)
        for name in rows.columns:
            odd = odd | F.col(name).isNull() | F.isnan(name)
        told = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(odd).alias("odd"), F.count_if(~F.col(rows.columns[-1]).isin(0.0, 1.0)).alias("other")).first()
        if not told["n"] or told["odd"] or told["other"]:
            raise ValueError(f"{told['n']} training rows, {told['odd']} with null or NaN, {told['other']} with a label that is not 0 or 1")
        shifts, directions, width = self.waves.shifts, self.waves.directions, len(self.waves.shifts)

        def summed(step: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
            parts = rows.mapInArrow(_summing(shifts, directions, step), "sums array<double>").select(F.posexplode("sums").alias("place", "s"))
            found = parts.groupBy("place").agg(F.sum("s").alias("s")).orderBy("place").collect()  # two rows a wave, or one
            return np.array([r["s"] for r in found]) / told["n"]

        moments = summed(_moments)
        spread = np.sqrt(np.maximum(moments[width:] - moments[:width] ** 2, 0) * told["n"] / max(1, told["n"] - 1))
        scale = np.divide(1.0, spread, out=np.zeros(width), where=spread > 0)

        def objective(flat: np.ndarray) -> tuple[float, np.ndarray]:
            got = summed(_hinge(flat[:-1] * scale, flat[-1]))
            slope = np.append(got[1:-1] * scale, got[-1])
            slope[:-1] += self.penalty * flat[:-1]
            return float(got[0] + 0.5 * self.penalty * (flat[:-1] ** 2).sum()), slope

        flat = _least(objective, np.zeros(width + 1), self.most, self.tol)
        return FourierMachineModel(self.waves, flat[:-1] * scale, float(flat[-1]))


class FourierMachineModel(Model):
    """Adds ``features``, ``rawPrediction`` and ``prediction``; the last two are null where a column is null."""

    def __init__(self, waves: RandomFourier, weights: np.ndarray, intercept: float):
        super().__init__()
        self.waves, self.weights, self.intercept = waves, weights, intercept

    def _transform(self, dataset: DataFrame) -> DataFrame:
        importable(dataset.sparkSession)
        made = self.waves.transform(dataset)
        shifts, directions, weights, intercept = self.waves.shifts, self.waves.directions, self.weights, self.intercept

        def margin(*columns: pa.Array) -> pa.Array:
            return pa.array(np.concatenate([_waves(some, shifts, directions) @ weights + intercept for some in _pieces(columns)] or [np.zeros(0)]).astype(np.float64))

        far = F.arrow_udf(margin, "double")(*[F.col(c).cast("double") for c in self.waves.columns])
        known = F.col(self.waves.out).isNotNull()
        made = made.withColumn("__margin", F.when(known, far))
        return made.withColumn("rawPrediction", F.when(known, array_to_vector(F.array(-F.col("__margin"), F.col("__margin"))))).withColumn(
            "prediction", F.when(known, (F.col("__margin") > 0).cast("double"))).drop("__margin")


def _pieces(columns: Sequence[pa.Array], step: int = 2_048) -> Iterator[np.ndarray]:
    rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])
    for at in range(0, len(rows), step):
        yield rows[at:at + step]


def _waves(rows: np.ndarray, shifts: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The features in single precision; wide angles are turned back in double precision first."""
    angle = rows @ directions.T + shifts
    if not np.abs(angle).max(initial=0) < 100:
        angle -= 2 * np.pi * np.rint(angle / (2 * np.pi))
    angle = angle.astype(np.float32)
    np.cos(angle, out=angle)
    angle *= np.float32(np.sqrt(2 / len(shifts)))
    return angle


def _summing(shifts: np.ndarray, directions: np.ndarray, step: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            for some in _pieces(batch.columns):
                total = total + step(_waves(some[:, :-1], shifts, directions), some[:, -1])
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sums"])

    return run


def _moments(made: np.ndarray, label: np.ndarray) -> np.ndarray:
    return np.concatenate([made.sum(axis=0, dtype=np.float64), (made * made).sum(axis=0, dtype=np.float64)])


def _hinge(weights: np.ndarray, intercept: float):
    single = weights.astype(np.float32)

    def step(made: np.ndarray, label: np.ndarray) -> np.ndarray:
        side = 2 * label - 1
        short = 1 - side * (made @ single + intercept)
        pull = np.where(short > 0, -side, 0.0)
        return np.concatenate([[np.maximum(short, 0).sum()], (made.T @ pull.astype(np.float32)).astype(np.float64), [pull.sum()]])

    return step


def _least(objective: Callable[[np.ndarray], tuple[float, np.ndarray]], at: np.ndarray, most: int, tol: float, memory: int = 10) -> np.ndarray:
    """Limited-memory quasi-Newton steps, each halved until the value falls enough."""
    value, slope = objective(at)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(most):
        way, used = slope.copy(), []
        for moved, turned in reversed(pairs):
            share = (moved @ way) / (moved @ turned)
            used.append(share)
            way -= share * turned
        if pairs:
            way *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1])
        for (moved, turned), share in zip(pairs, reversed(used)):
            way += (share - (turned @ way) / (moved @ turned)) * moved
        fall = way @ slope
        if fall <= 0:
            way, fall, pairs = slope.copy(), slope @ slope, []
        length = 1.0 if pairs else 1.0 / max(1e-12, np.sqrt(slope @ slope))
        for _ in range(20):
            new, new_slope = objective(at - length * way)
            if new <= value - 1e-4 * length * fall:
                break
            length /= 2
        else:
            return at
        moved, turned = -length * way, new_slope - slope
        if moved @ turned > 1e-10 * (moved @ moved):
            pairs = [*pairs, (moved, turned)][-memory:]
        done = value - new <= tol * max(abs(value), abs(new), 1e-6)
        at, value, slope = at + moved, new, new_slope
        if done:
            break
    return at


class Perceptron:
    """Weights of a multi-layer perceptron with hyperbolic tangents and a linear end, as one flat vector."""

    def __init__(self, sizes: Sequence[int]):
        self.shapes = list(zip(sizes[:-1], sizes[1:]))
        self.length = sum((a + 1) * b for a, b in self.shapes)

    def start(self, seed: int) -> np.ndarray:
        random = np.random.default_rng(seed)
        return np.concatenate([np.append(random.normal(0, 1 / np.sqrt(a), a * b), np.zeros(b)) for a, b in self.shapes])

    def layers(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out, at = [], 0
        for a, b in self.shapes:
            out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
            at += (a + 1) * b
        return out

    def predict(self, flat: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.forward(flat, rows)[-1][:, 0]

    def forward(self, flat: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        layers, seen = self.layers(flat), [rows]
        for k, (weights, bias) in enumerate(layers):
            sums = seen[-1] @ weights + bias
            seen.append(np.tanh(sums) if k + 1 < len(layers) else sums)
        return seen

    def slope(self, flat: np.ndarray, rows: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Gradient of the mean squared error, halved."""
        layers, seen = self.layers(flat), self.forward(flat, rows)
        error, parts = (seen[-1] - target[:, None]) / len(rows), []
        for k in range(len(layers) - 1, -1, -1):
            parts.append(np.append((seen[k].T @ error).ravel(), error.sum(axis=0)))
            if k:
                error = (error @ layers[k][0].T) * (1 - seen[k] ** 2)
        return np.concatenate(parts[::-1])


class PerceptronRegressor(Estimator):
    """Multi-layer perceptron for a number, trained by local steps and averaging.

    In each round every partition takes Adam steps over its own rows from the
    common weights; the next common weights are the mean over partitions,
    weighted by their rows. Only sums per weight leave the executors. Columns and
    target are scaled by the training rows' mean and deviation; rows with a
    null or NaN are left out.
    """

    def __init__(self, columns: Sequence[str], target: str, hidden: Sequence[int] = (16, 16), rounds: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 0, out: str = "prediction"):
        super().__init__()
        self.columns, self.target, self.hidden, self.out = list(columns), target, list(hidden), out
        self.rounds, self.batch, self.rate, self.seed = rounds, batch, rate, seed

    def _fit(self, dataset: DataFrame) -> PerceptronModel:
        importable(dataset.sparkSession)
        names = [*self.columns, self.target]
        numbers = [F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(names)]
        rows = materialised(dataset.select(*numbers), "perceptron")
        for name in rows.columns:
            rows = rows.filter(F.col(name).isNotNull() & ~F.isnan(name))
        told = rows.agg(*[f(c) for c in rows.columns for f in (F.avg, F.stddev_pop)]).first()
        if told[0] is None:
            raise ValueError("no training rows without nulls")
        means, spreads = np.array(told[::2]), np.array([s or 1.0 for s in told[1::2]])
        network = Perceptron([len(self.columns), *self.hidden, 1])
        flat = network.start(self.seed)
        for turn in range(self.rounds):
            step = _local_steps(network, flat, means, spreads, self.batch, self.rate / (1 + turn / 4), self.seed + turn)
            summed = rows.mapInArrow(step, "n double, weights array<double>").select("n", F.posexplode("weights").alias("place", "weight"))
            found = summed.groupBy("place").agg((F.sum(F.col("n") * F.col("weight")) / F.sum("n")).alias("weight")).orderBy("place").collect()  # one row a weight
            flat = np.array([r["weight"] for r in found])
        return PerceptronModel(self.columns, self.out, network, flat, means, spreads)


def _local_steps(network: Perceptron, flat: np.ndarray, means: np.ndarray, spreads: np.ndarray, size: int, rate: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, first, second, steps, seen = flat.copy(), np.zeros(network.length), np.zeros(network.length), 0, 0
        random = np.random.default_rng(seed)
        for batch in batches:
            rows = (np.column_stack([c.to_numpy() for c in batch.columns]) - means) / spreads
            rows = rows[random.permutation(len(rows))]
            seen += len(rows)
            for at in range(0, len(rows), size):
                some = rows[at:at + size]
                slope = network.slope(weights, some[:, :-1], some[:, -1])
                steps += 1
                first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope ** 2
                weights -= rate * (first / (1 - 0.9 ** steps)) / (np.sqrt(second / (1 - 0.999 ** steps)) + 1e-8)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([float(seen)]), pa.array([weights.tolist()], pa.list_(pa.float64()))], names=["n", "weights"])

    return run


class PerceptronModel(Model):
    """Adds the prediction, null where a column is null or NaN; the first layer's scaling is part of the expression."""

    def __init__(self, columns: Sequence[str], out: str, network: Perceptron, flat: np.ndarray, means: np.ndarray, spreads: np.ndarray):
        super().__init__()
        self.columns, self.out, self.network, self.flat, self.means, self.spreads = list(columns), out, network, flat, means, spreads

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = F.array(*[(F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(self.columns, self.means, self.spreads)])
        layers = self.network.layers(self.flat)
        for k, (weights, bias) in enumerate(layers):
            table = F.array(*[F.struct(F.array(*[F.lit(float(w)) for w in weights[:, j]]).alias("w"), F.lit(float(bias[j])).alias("b")) for j in range(weights.shape[1])])
            values = _layer(table, values, k + 1 < len(layers))
        known = F.lit(True)
        for column in self.columns:
            known = known & F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))
        return dataset.withColumn(self.out, F.when(known, values[0] * F.lit(float(self.spreads[-1])) + F.lit(float(self.means[-1]))))


def _layer(table, values, bent: bool):
    """One layer over an array of values; the array is bound once, by a transform over the one-element array of it."""
    def unit(v):
        def one(node):
            total = F.aggregate(F.zip_with(node.w, v, lambda a, b: a * b), node.b, lambda s, x: s + x)
            return F.tanh(total) if bent else total

        return F.transform(table, one)

    return F.transform(F.array(values), unit)[0]
