"""Reports on stored files and tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.plans.literals import literal_table
from tallyloom.plans.workers import importable
from tallyloom.sources.files import list_files

_FOOTER = (
    "path string, row_group int, n_rows bigint, column string, physical_type string, codec string, "
    "compressed_bytes bigint, uncompressed_bytes bigint, min_value string, max_value string, null_count bigint"
)


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.fs as fs
    import pyarrow.parquet as pq

    for batch in batches:
        rows = []
        for uri in batch["path"]:
            system, path = fs.FileSystem.from_uri(uri)
            with system.open_input_file(path) as handle:
                meta = pq.ParquetFile(handle).metadata
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        chunk = group.column(c)
                        stats = chunk.statistics
                        ranged = stats is not None and stats.has_min_max
                        rows.append((
                            uri, g, group.num_rows, chunk.path_in_schema, chunk.physical_type, chunk.compression,
                            chunk.total_compressed_size, chunk.total_uncompressed_size,
                            str(stats.min) if ranged else None, str(stats.max) if ranged else None,
                            stats.null_count if stats is not None and stats.has_null_count else None,
                        ))
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in _FOOTER.split(", ")]).astype(
            {"row_group": "int32", "null_count": "Int64"}
        )


def parquet_footers(spark: SparkSession, path: str) -> DataFrame:
    """Row groups and column chunks of Parquet files; tasks read footers only."""
    importable(spark)
    files = list_files(spark, path, "*.parquet").select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"))
    return files.mapInPandas(_read_footers, _FOOTER)


def table_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Rows, row groups, columns and bytes per file, from footers."""
    footers = parquet_footers(spark, path)
    per_column = footers.groupBy("path", "row_group").agg(
        F.max("n_rows").alias("n_rows"),
        F.count_distinct(F.element_at(F.split("column", r"\."), 1)).alias("columns"),
        F.sum("compressed_bytes").alias("bytes"),
    )
    return per_column.groupBy("path").agg(
        F.sum("n_rows").alias("rows"), F.count(F.lit(1)).alias("row_groups"),
        F.max("columns").alias("columns"), F.sum("bytes").alias("bytes"),
    )


def size_by_format(files: DataFrame) -> DataFrame:
    """Files and bytes per file ending."""
    ending = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    return files.groupBy(ending.alias("format")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def describe_columns(df: DataFrame) -> DataFrame:
    """Name, type and position of every column, as a table."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return literal_table(df.sparkSession, rows, "position int, column string, type string, nullable boolean")
