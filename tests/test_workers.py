"""Python steps run wherever the driver is started."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

_HOME = Path(__file__).resolve().parents[1]
_SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from tallyloom.operators.clustering import silhouette_euclidean
from tallyloom.operators.density import dbscan_vectors
from tallyloom.operators.kernels import PerceptronRegressor
from tallyloom.operators.neighbours import knn_join
from tallyloom.session import build_session
from tallyloom.sources.layout import parquet_footers

spark = build_session("elsewhere", "local[2]", **{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.log.level": "ERROR"})
rows = spark.range(12).selectExpr("id", "array(CAST(id AS double), CAST(id % 3 AS double)) AS v", "id % 2 AS k", "CAST(id AS double) AS x", "CAST(2 * id AS double) AS y")
print(knn_join(rows, rows, "id", "id", "v", 2, exclude_self=True).count())
print(dbscan_vectors(rows, "id", "v", 3.0, 2).count())
print(silhouette_euclidean(rows, "id", "v", "k").count())
print(PerceptronRegressor(["x"], "y", rounds=1).fit(rows).transform(rows).count())
rows.write.parquet(sys.argv[2])
print(parquet_footers(spark, sys.argv[2]).count() > 0)
"""


def test_driver_in_another_folder(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", _SCRIPT, str(_HOME), str(tmp_path / "rows")], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=240)
    assert done.stdout.split() == ["24", "12", "12", "12", "True"], done.stderr[-2000:]
