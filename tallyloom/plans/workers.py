"""Python workers that find this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def importable(spark: SparkSession) -> None:
    """Gives Python workers on this machine the package's place, wherever the driver was started.

    Called before a Python step is planned, since that takes the environment
    of its moment. On a cluster the package is installed or sent with ``--py-files``.
    """
    home = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([home, *paths])
