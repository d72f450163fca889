"""Wall time of the headline queries.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Prints one
JSON line. Each query is materialised in full by the no-op sink; the number is
the median of three runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "a1_group_count", "a2_named_aggregates", "a5_distinct_count", "a10_describe", "a10_global_quantiles", "a16_rollup",
    "f4_timestamp_floor", "f8_payload_hash", "g4_count_by_area_and_time", "i1_flatten_rainfall", "i6_dedupe_records",
    "j1_fact_to_dimension", "j2_left_two_keys", "j4_anti_join_audit", "j5_interval_asof", "j6_point_in_time", "j7_future_target",
    "j13_semi_join", "o4_top_k_per_group", "q1_column_profile", "q5_group_median_impute", "s3_parquet_scan", "t3_session_activity",
    "u3_dedupe_by_key", "u6_pivot", "v3_area_snapshot", "v4_current_snapshot", "v10_trip_questions", "w2_top_one_per_group",
    "w4_lag_demand", "w5_rolling_features", "w7_decile_table", "e3_classification_report", "e4_roc_auc", "e7_threshold_sweep",
    "m1_stratified_split", "m3_scaling", "m20_impurity_table", "m26_lloyd_assign", "m29_nearest_neighbours",
    "x7_numeric_drift", "x10_performance_slices", "x11_ks",
)


def main() -> None:
    from tallyloom.queries import QUERIES
    from tallyloom.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = sys.argv[1:]
    spark = build_session(
        "bench", f"local[{cpus}]", **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g", "spark.log.level": "ERROR",
        })
    seconds: dict[str, float] = {}
    for name in HEADLINE if not only else only:
        times = []
        for _ in range(repeats + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
