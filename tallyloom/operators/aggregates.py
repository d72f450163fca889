"""Aggregates with the null and bin rules of in-memory data frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.plans.nullsafe import join_on
from tallyloom.plans.ordering import exact_quantiles


def distinct_with_null(column: str) -> Column:
    """Distinct values of a column where null counts as one value."""
    return F.count_distinct(column) + F.max(F.col(column).isNull().cast("int"))


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """Count and share per value; null is dropped unless ``dropna`` is off."""
    rows = df.filter(F.col(column).isNotNull()) if dropna else df
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / counts.select(F.sum("n")).scalar())


def cross_tab(df: DataFrame, rows: str, columns: str, values: Sequence) -> DataFrame:
    """Counts by two columns, zero where a pair does not occur.

    The column values are given, so no extra pass finds them; a row with any
    other value or null is an error.
    """
    message = F.concat(F.lit(f"value of {columns} not listed: "), F.coalesce(F.col(columns).cast("string"), F.lit("null")))
    listed = F.when(F.col(columns).isin(list(values)), F.col(columns)).otherwise(F.raise_error(message))
    return df.withColumn(columns, listed).groupBy(rows).pivot(columns, list(values)).count().na.fill(0)


def describe(df: DataFrame, column: str, keys: Sequence[str], digits: int) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per group."""
    basic = df.groupBy(*keys).agg(
        F.count(column).alias("n"),
        F.round(F.avg(column), digits).alias("mean"),
        F.round(F.stddev_samp(column), digits).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    spread = exact_quantiles(df, column, {"q25": 0.25, "median": 0.5, "q75": 0.75}, keys)
    rounded = spread.select(*keys, *[F.round(c, digits).alias(c) for c in ("q25", "median", "q75")])
    return join_on(basic, rounded, list(keys), "left")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, in one aggregation."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    table = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(F.inline(table))


def mean_difference(df: DataFrame, keys: Sequence[str], column: str, wrong: Column) -> DataFrame:
    """Mean among wrong and right rows and their relative difference."""
    means = df.groupBy(*keys).agg(
        F.avg(F.when(wrong, F.col(column))).alias("wrong_mean"),
        F.avg(F.when(~wrong, F.col(column))).alias("right_mean"),
    )
    gap = F.col("wrong_mean") - F.col("right_mean")
    return means.withColumn("percent", 100 * F.try_divide(gap, F.col("right_mean")))


def histogram(
    df: DataFrame, column: str, low: float, high: float, bins: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Equal bins over [low, high], the last one closed, with density.

    Bin -1 counts the values below and bin ``bins`` those above, without a
    density; null values are left out.
    """
    width = (high - low) / bins
    inner = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    bin_no = F.when(F.col(column) < low, F.lit(-1)).when(F.col(column) > high, F.lit(bins)).otherwise(inner)
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*keys, bin_no.cast("long").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    within = F.col("bin").between(0, bins - 1)
    total = F.sum(F.when(within, F.col("n"))).over(Window.partitionBy(*keys))  # at most ``bins`` + 2 rows per group
    return counts.withColumn("density", F.when(within, F.col("n") / (total * F.lit(width))))
