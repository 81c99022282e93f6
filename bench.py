"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the folder of Parquet tables (default /root/testdata/sf0.1), ``BENCH_CPUS`` the
number of local cores (default 8). Each query runs in full into a sink that discards its rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattloom.catalog import all_queries  # noqa: E402
from wattloom.session import build_session  # noqa: E402

HEADLINE = [
    "x1_enrich_halfhourly",
    "x2_demographic_share",
    "x3_efficiency_by_group",
    "x4_tariff_slot_usage",
    "x5_slot_pivot_acorn",
    "x7_daily_weather_features",
    "x8_household_series_features",
    "x11_forecast_features",
    "x12_time_of_day_profiles",
    "x13_actual_vs_potential",
    "x14_weekly_tariff_mode",
    "x15_profile_describe",
    "x16_smoothed_weather",
    "x17_daily_with_households",
    "j7_star_join",
    "a10_describe",
    "a11_corr_matrix",
    "a13_quantiles",
    "a14_histogram",
    "a15_kde",
    "a17_pivot_mean",
    "a25_word_freq",
    "w1_share_of_group",
    "w3_rolling_sum",
    "w3_rolling_sum_events",
    "m7_train_random_forest",
    "x9_train_evaluate_export",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()

    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
