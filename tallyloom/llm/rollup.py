"""Delta-maintained token counts.

A batch of changes is reduced to signed totals by source, language and
tokenizer version, and committed under its batch id. Totals are the sum over
all committed batches. A batch is replaced, never added twice, so that a retry
or a repeated delivery changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")


def signed_totals(changes: DataFrame) -> DataFrame:
    """Sums of signed documents and tokens per group, from ``change_id``, group columns, ``before`` and ``after``.

    ``before`` and ``after`` are a document's token counts: an insert has no
    ``before``, a delete no ``after``, a revision both. A change delivered
    twice within the batch (same ``change_id``; null ids are all different)
    counts once; should its deliveries differ, the least of them does. Null
    group values are a group.
    """
    signs = (F.col("after").isNotNull().cast("long") - F.col("before").isNotNull().cast("long"))
    tokens = F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0))
    named = changes.filter("change_id IS NOT NULL").groupBy("change_id").agg(F.min(F.struct(*KEYS, "before", "after")).alias("change"))
    all_ = named.select("change.*").unionByName(changes.filter("change_id IS NULL").select(*KEYS, "before", "after"))
    return all_.groupBy(*KEYS).agg(F.sum(signs).cast("long").alias("d_docs"), F.sum(tokens).cast("long").alias("d_tokens"))


class Rollup:
    """Totals kept in a folder that all executors share, one Parquet folder per batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, batch_id: str, changes: DataFrame) -> None:
        """Write the batch's totals; a batch committed before is replaced by the same id's content as a whole."""
        if not batch_id or not all(c.isalnum() or c in "-_" for c in batch_id):
            raise ValueError("batch ids are letters, digits, - and _")
        signed_totals(changes).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def totals(self) -> DataFrame:
        """Documents and tokens per group that has any change, zero groups left out."""
        deltas = self.spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")
        summed = deltas.groupBy(*KEYS).agg(F.sum("d_docs").cast("long").alias("n_docs"), F.sum("d_tokens").cast("long").alias("n_tokens"))
        return summed.filter("n_docs <> 0 OR n_tokens <> 0")


def count_tokens(text: Column, pattern: str) -> Column:
    """Matches of a pattern in a text; null texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")
