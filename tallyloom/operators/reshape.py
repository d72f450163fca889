"""Deduplication and layout changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.selection import keep_first


def dedupe_text(df: DataFrame, text: str, row_id: str) -> DataFrame:
    """One row per distinct text, the one with the lowest id.

    Only a digest of the text is shuffled and compared; the text column itself
    leaves the plan unless the caller keeps it.
    """
    keyed = df.withColumn("__digest", F.sha2(F.col(text), 256)).drop(text)
    return keep_first(keyed, ["__digest"], [F.col(row_id)]).drop("__digest")


def to_column_blocks(df: DataFrame, key: str, block_size: int) -> DataFrame:
    """Rows to one array per column, in blocks of ``block_size`` key values."""
    rest = [c for c in df.columns if c != key]
    rows = F.sort_array(F.collect_list(F.struct(key, *rest))).alias("__rows")
    block = F.floor(F.col(key) / F.lit(block_size)).cast("long").alias("block")
    return df.groupBy(block).agg(rows).select("block", *[F.col(f"__rows.{c}").alias(c) for c in (key, *rest)])


def from_column_blocks(blocks: DataFrame) -> DataFrame:
    """Inverse of ``to_column_blocks``."""
    columns = [c for c in blocks.columns if c != "block"]
    return blocks.select(F.inline(F.arrays_zip(*columns))).toDF(*columns)
