"""Fit/transform objects for ML pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.ordering import exact_quantiles
from tallyloom.plans.scratch import checkpointed


class GroupMedianImputer(Estimator):
    """Learns exact medians per group and overall from the training rows."""

    def __init__(self, keys: Sequence[str], column: str, out: str):
        super().__init__()
        self.keys, self.column, self.out = list(keys), column, out

    def _fit(self, dataset: DataFrame) -> GroupMedianImputerModel:
        groups = checkpointed(exact_quantiles(dataset, self.column, {"__median": 0.5}, self.keys))
        overall = exact_quantiles(dataset, self.column, {"m": 0.5}).first()
        return GroupMedianImputerModel(self.keys, self.column, self.out, groups, None if overall is None else overall["m"])


class GroupMedianImputerModel(Model):
    """Fills from the learned medians; later rows do not change them."""

    def __init__(self, keys, column, out, groups: DataFrame, overall: float | None):
        super().__init__()
        self.keys, self.column, self.out, self.groups, self.overall = keys, column, out, groups, overall

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = F.coalesce(F.col(self.column), F.col("__median"), F.lit(self.overall))
        return dataset.join(self.groups, self.keys, "left").withColumn(self.out, filled).drop("__median")
