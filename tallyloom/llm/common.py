"""What the text operators share: word classes, folds and row-wise Arrow steps."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

#: Words cut at ASCII white space; ``bytes.split`` cuts UTF-8 text at the same places.
WORDS = r"[^\x20\x09-\x0D]+"
#: Words of lower-cased text: ASCII digits, a-z and all characters beyond ASCII.
TERMS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words of UTF-8 bytes.
TERM_BYTES = rb"[0-9a-z\x80-\xff]+"


_KINDS: dict[str, DataType] = {"long": LongType(), "int": IntegerType(), "double": DoubleType(), "boolean": BooleanType(), "string": StringType(), "binary": BinaryType()}


def fields(**kinds: str | DataType) -> StructType:
    """Schema from column names and type names (``list_int`` is an array), without a running session."""
    def kind(k: str | DataType) -> DataType:
        if isinstance(k, DataType):
            return k
        return ArrayType(kind(k.removeprefix("list_"))) if k.startswith("list_") else _KINDS[k]

    return StructType([StructField(name, kind(k)) for name, k in kinds.items()])


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "4m") -> None:
    """Arrow batches of a bounded number of rows and bytes, so that long texts don't pile up in a task.

    Local Python workers also get this package's place; on a cluster the package is installed or sent with ``--py-files``.
    """
    home = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % F.lit(folds)


def packed(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the input's columns, or those in ``keep``, as one struct) and ``body`` (the text as UTF-8 bytes).

    Added columns can't clash with the input's, since those stay inside the struct.
    """
    columns = docs.columns if keep is None else keep
    return docs.select(F.struct(*[docs[c] for c in columns]).alias("row"), docs[text].cast("binary").alias("body"))


def appended(frame: DataFrame, inputs: list[str], step: Callable[..., list[pa.Array]], schema: StructType) -> DataFrame:
    """``row`` plus the columns that ``step`` makes of each batch's ``inputs`` (as lists of Python values)."""
    names = ["row", *schema.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = step(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs])
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("row")), *made], names=names)

    bounded_batches(frame.sparkSession)
    out = StructType([frame.schema["row"], *schema.fields])
    return frame.select("row", *inputs).mapInArrow(run, out)


def per_document(docs: DataFrame, step: Callable[[list[bytes | None]], list[pa.Array]], schema: StructType, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    return appended(packed(docs, text, keep), ["body"], step, schema)
