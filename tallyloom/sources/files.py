"""File scans and sinks. Schemas are declared, never inferred, for real loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Text formats drop fractions of a second below a millisecond unless told so.
_MOMENT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, columns: Sequence[str] = ()) -> DataFrame:
    """CSV with header and declared types; bad rows keep their raw text in
    ``_corrupt_record`` when the schema has that column."""
    rows = (
        spark.read.schema(schema)
        .options(**_MOMENT)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return rows.select(*columns) if columns else rows


def discover_csv(spark: SparkSession, path: str) -> T.StructType:
    """Inferred schema of a CSV, to be reviewed and declared."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path).schema


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).options(**_MOMENT).option("header", True).option("escape", '"').csv(path)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One document per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(**_MOMENT).json(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").options(**_MOMENT).json(path)


def write_parquet(
    df: DataFrame,
    path: str,
    sort: Sequence[str] = (),
    codec: str = "zstd",
    row_group_bytes: int = 128 * 1024 * 1024,
    mode: str = "errorifexists",
) -> None:
    """Parquet with a codec and row-group size; sorting inside each file keeps
    the min/max ranges of row groups narrow, so filters skip more of them."""
    rows = df.sortWithinPartitions(*sort) if sort else df
    rows.write.mode(mode).option("compression", codec).option(
        "parquet.block.size", str(row_group_bytes)
    ).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "errorifexists") -> None:
    """Hive-style folders; an existing target is refused by default.

    Adaptive rebalancing by the partition columns writes few files per folder
    and still splits a folder that is much larger than the others.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row counts of both sides and rows that only one of them has.

    Rows are dealt by a digest before they are counted: a task then holds a
    share of the shuffle, and no map of all rows of a scan.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    tag_a = a.select(*a.columns, one.alias("__n"), none.alias("__m"))
    tag_b = b.select(*a.columns, none.alias("__n"), one.alias("__m"))
    dealt = tag_a.unionByName(tag_b).withColumn("__h", F.xxhash64(*a.columns)).repartition("__h")
    both = dealt.groupBy("__h", *a.columns).agg(F.sum("__n").alias("n"), F.sum("__m").alias("m"))
    gap = F.col("n") - F.col("m")
    return both.agg(
        F.sum("n").alias("left_rows"), F.sum("m").alias("right_rows"),
        F.sum(F.greatest(gap, F.lit(0))).alias("left_only"), F.sum(F.greatest(-gap, F.lit(0))).alias("right_only"),
    )


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Path, size and time of files below a folder, contents not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "modificationTime")


def latest_by_prefix(files: DataFrame, name_pattern: str) -> DataFrame:
    """Greatest name per prefix. ``name_pattern`` has two groups in the path:
    the prefix and the sortable stamp."""
    named = files.select(
        F.regexp_extract("path", name_pattern, 1).alias("prefix"),
        F.regexp_extract("path", name_pattern, 2).alias("stamp"),
    ).filter(F.col("prefix") != "")
    return named.groupBy("prefix").agg(F.max("stamp").alias("stamp"))
