"""Compare registered queries with DuckDB on the same Parquet files.

Run ``python tests/oracle.py [sf_dir] [name-prefix ...]`` for a report.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyloom.session import TABLES  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return repr(0.0 if value == 0 else value)
    if isinstance(value, pd.Timestamp):
        return str(value.to_pydatetime())
    return str(value)


def bag(frame: pd.DataFrame) -> Counter:
    frame = frame[sorted(frame.columns)]
    return Counter(tuple(_cell(v) for v in row) for row in frame.itertuples(index=False))


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when equal, else a short description of the difference."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    got = got.copy()
    for column in got.columns:
        if str(want[column].dtype) == "Int64" and str(got[column].dtype) == "float64":
            got[column] = got[column].astype("Int64")  # toPandas gives long columns with nulls as floats
        kinds = {str(got[column].dtype), str(want[column].dtype)}
        families = {"time" if k.startswith("datetime") else k.rstrip("0123456789").lower() for k in kinds}
        families = {"str" if k in ("object", "string") else k for k in families}
        if len(got) and len(families) > 1:
            return f"column {column} has types {sorted(kinds)}"
    left, right = bag(got), bag(want)
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (
        f"rows {len(got)} vs {len(want)}; "
        f"spark only {list(only_left.items())[:2]}; duckdb only {list(only_right.items())[:2]}"
    )


def main(argv: list[str]) -> int:
    from tallyloom.queries import ORACLES, QUERIES
    from tallyloom.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:])
    spark = build_session(
        "oracle", "local[8]", **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g", "spark.log.level": "ERROR",
        })
    con = connect(sf_dir)
    bad = 0
    for name, run in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        started = time.time()
        try:
            got = run(spark, sf_dir).toPandas()
            seconds = time.time() - started
            if name not in ORACLES:
                print(f"rows  {name} {len(got)} rows {seconds:.1f}s", flush=True)
                continue
            started = time.time()
            problem = compare(got, con.execute(ORACLES[name]).df())
            sql_seconds = time.time() - started
        except Exception as error:  # report and go on
            problem, seconds, sql_seconds = f"{type(error).__name__}: {str(error)[:900]}", time.time() - started, 0
        if problem:
            bad += 1
            print(f"FAIL  {name}: {problem}", flush=True)
        else:
            print(f"ok    {name} {len(got)} rows {seconds:.1f}s / {sql_seconds:.1f}s", flush=True)
    print(f"{bad} failures")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
