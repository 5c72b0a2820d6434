"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores.  Each query is built and fully
executed into a sink that discards the rows, so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loadcast.catalog import QUERIES  # noqa: E402
from loadcast.session import build_session  # noqa: E402

HEADLINE = (
    "feature_assembly training_set rolling_mean rolling_median rolling_with_gaps lag_features "
    "lead_target chrono_split time_series_folds asof_join left_join_weather merge_metrics "
    "pivot_metrics region_mean region_mean_strict trim_last_valid dropna_keep_last "
    "complete_day_trim dedupe_latest last_n_per_key latest_per_region emit_on_change "
    "prediction_assembly debug_join_future accuracy_metrics mae_by_region mutual_information "
    "standardize hourly_profile weekday_weekend_profile holiday_flag cyclical_features "
    "local_time project_raw json_explode weather_arrays registry_pick counts_rollup "
    "upsert_latest feature_view_range stream_features stream_features_late stream_readings "
    "model_training model_scoring"
).split()


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "feature_assembly", sf_dir)  # class loading and code generation
    queries = {name: run(spark, name, sf_dir) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
