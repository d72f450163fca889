"""Shared scratch space: reliable checkpoints and intermediate tables.

On a cluster the folder is the one named by ``spark.checkpoint.dir``, which all
executors can reach, so work survives the loss of an executor. Only a local
session without that setting falls back to a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tallyloom-")
    return _local_roots[context.applicationId]


def run_dir(spark: SparkSession, purpose: str) -> str:
    """Path of a new, not yet existing folder for one run."""
    return f"{shared_root(spark)}/tallyloom/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and cut its lineage."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_root(spark)}/checkpoints")
    return df.checkpoint(eager=True)


def materialised(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once as a Parquet table and read it back.

    Used where several later steps need the same result: the table keeps its
    statistics and column pruning, which an RDD-backed checkpoint does not.
    """
    path = run_dir(df.sparkSession, purpose)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
