"""JSON documents and nested values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_json(column: Column) -> Column:
    """Same document, keys sorted, no blanks (null when it is not JSON)."""
    return F.to_json(F.try_parse_json(column))


def payload_hash(column: Column) -> Column:
    """SHA-256 of the canonical document."""
    return F.sha2(canonical_json(column), 256)


def is_valid_json(column: Column) -> Column:
    return F.try_parse_json(column).isNotNull()


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """One column per leaf of nested structs, named by its path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                source = F.col(".".join(f"`{p}`" for p in here))
                yield source.alias(separator.join(here))

    return df.select(*leaves(df.schema, ()))


def preview(df: DataFrame, items: int = 3, chars: int = 80) -> DataFrame:
    """Short form of nested documents: arrays and texts are cut for display."""

    def cut(value: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StringType):
            return F.when(F.length(value) > chars, F.concat(F.substring(value, 1, chars), F.lit("..."))).otherwise(value)
        if isinstance(kind, T.ArrayType):
            return F.transform(F.slice(value, 1, items), lambda v: cut(v, kind.elementType))
        if isinstance(kind, T.StructType):
            inner = [cut(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
            return F.when(value.isNotNull(), F.struct(*inner))
        return value

    return df.select(*[cut(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def feature_collection(df: DataFrame, keys: list[str], properties: list[str], order: str) -> DataFrame:
    """One JSON document per key: features with properties, and a summary.

    A document is one array, so keys are meant to be coarse and their members
    a bounded dimension (areas of a region), never a fact table.
    """
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"))
    members = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), feature.alias("f"))))
    grouped = df.groupBy(*keys).agg(members.alias("__m"), F.count(F.lit(1)).alias("__n"))
    document = F.struct(
        F.lit("FeatureCollection").alias("type"),
        F.col("__m.f").alias("features"),
        F.struct(F.col("__n").alias("count")).alias("summary"),
    )
    return grouped.select(*keys, F.to_json(document).alias("document"))
