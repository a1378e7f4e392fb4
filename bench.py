"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores,
BENCH_QUERIES (comma separated, or "all") the queries. Results go to Spark's no-op sink, so a time is
that of the whole query without a transfer to Python.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))
from formline.suite import QUERIES  # noqa: E402

HEADLINE = [
    "rolling_avg_std", "season_min_max", "career_min_max", "season_cumulative_total", "lag_change",
    "all_time_series_features", "days_rest", "career_games_played", "recent_form", "contextual_features",
    "full_features", "lookup_join", "select_players", "top_k_per_group", "null_counts", "duplicate_keys",
    "merge_report", "multi_hot", "describe_columns", "outlier_summary", "histogram", "correlation_pairs",
    "time_split", "regression_metrics", "metric_comparison", "importance_table", "train_metrics",
    "full_feature_report", "opponent_table", "career_logs", "gain_importance", "sample_per_group",
]


def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else [n for n in asked.split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("formline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))  # one machine: any folder is shared
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "profile_summary", folder)  # start-up and file listing are not part of any query
    times = {name: round(run(spark, name, folder), 3) for name in names}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
