"""Row and column selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose value differs, missing values included."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def label_slice(df: DataFrame, key: str, first, last) -> DataFrame:
    """Rows whose key lies in the closed range; the key takes an index's part."""
    return df.filter((F.col(key) >= F.lit(first)) & (F.col(key) <= F.lit(last)))


def positional_slice(
    df: DataFrame, order: Sequence[Column], start: int, stop: int, first: int, last: int
) -> DataFrame:
    """Rows [start, stop) of an explicit order and columns [first, last).

    Offset and limit after a sort is a top-k of ``stop`` rows per partition, so
    no window over the whole table is needed.
    """
    return df.orderBy(*order).offset(start).limit(stop - start).select(df.columns[first:last])


def columns_of(df: DataFrame, kind: str) -> DataFrame:
    """Columns of one kind: number, text, time or boolean."""
    kinds = {
        "number": (T.NumericType,),
        "text": (T.StringType,),
        "time": (T.DateType, T.TimestampType, T.TimestampNTZType),
        "boolean": (T.BooleanType,),
    }[kind]
    return df.select([f.name for f in df.schema.fields if isinstance(f.dataType, kinds)])


def at_or_latest(df: DataFrame, moment: Column, requested) -> DataFrame:
    """Rows at the requested moment, or at the latest one when it is None."""
    if requested is not None:
        return df.filter(moment == F.lit(requested))
    latest = df.select(F.max(moment).alias("__latest"))
    return df.join(latest, moment == F.col("__latest"), "left_semi")


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, out: str = "rn"
) -> DataFrame:
    """First ``k`` rows per group; each task cuts its groups to ``k`` rows
    before the shuffle (WindowGroupLimit), so hot groups stay small."""
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(out) <= k).withColumn(out, F.col(out).cast("long"))


def best_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The single row per group with the greatest order values.

    An aggregate, not a window: it combines before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("__b")
    )
    return best.select(*keys, *[F.col("__b")[c].alias(c) for c in rest])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order; null keys are equal."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("__b")
    )
    return first.select(*keys, *[F.col("__b")[c].alias(c) for c in rest])
