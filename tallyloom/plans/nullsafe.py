"""Joins in which null keys meet null keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on equal keys, null equal to null; the result has the left's keys."""
    names = {k: f"__right_{i}" for i, k in enumerate(keys)}
    renamed = right.withColumnsRenamed(names)
    if not keys:
        return left.crossJoin(renamed) if how in ("inner", "left") else left.join(renamed, F.lit(True), how)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(renamed, same, how).drop(*names.values())
