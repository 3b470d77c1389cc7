"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder and ``BENCH_CPUS`` the cores. Every query is computed in full
and discarded; the reported time is the median of the timed runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from matchday.registry import Inputs, load

HEADLINE = (
    "src_incremental", "int_schedules", "agg_team_week", "agg_team_week_sql", "agg_score_data",
    "join_result", "join_sides_merge", "rf_training_data_weighted", "rf_training_data", "int_weekly_score",
    "agg_lag", "join_lag_features", "join_lag_features_kicking", "rf_prediction_inputs",
    "agg_profile_sides", "join_profile", "agg_describe", "agg_corr", "agg_kde",
    "win_expanding", "ml_impute_mean", "ml_class_report", "ml_cv_folds", "ml_backtest_score",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("matchday-bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = load()

    def once(name: str) -> float:
        start = time.perf_counter()
        df = registered[name].run(Inputs(spark, folder))
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in chosen:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
