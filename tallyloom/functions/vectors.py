"""Expressions over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _differences(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))


def l1(a: Column, b: Column) -> Column:
    return F.aggregate(_differences(a, b), F.lit(0.0), lambda s, d: s + d)


def squared_l2(a: Column, b: Column) -> Column:
    return F.aggregate(_differences(a, b), F.lit(0.0), lambda s, d: s + d * d)


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(squared_l2(a, b))


def linf(a: Column, b: Column) -> Column:
    return F.array_max(_differences(a, b))


def arg_max(vector: Column) -> Column:
    """Position from 0 of the first largest element."""
    return F.array_position(vector, F.array_max(vector)) - 1
