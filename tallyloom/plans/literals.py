"""Small literal tables built inside the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A handful of constant rows as expressions: no Python task reads them,
    and the optimizer knows that the table is tiny."""
    fields = T._parse_datatype_string(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows
    ]
    one = spark.range(0, 1, 1, 1)
    if not structs:
        empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
        return one.filter(F.lit(False)).select(F.inline(F.array(empty)))
    return one.select(F.inline(F.array(*structs)))
