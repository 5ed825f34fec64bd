"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "a1_grouped_stats_items", "a2_hour_bucket_stats", "a5_two_key_stats", "a8_numeric_summary", "a12_hour_weekday_matrix",
    "a16_histogram", "a17_box_summary", "a19_energy_cost", "c2_target_correlations", "c4_correlation_matrix",
    "c6_mutual_information", "cleaning_job", "d1_keep_first", "d3_exact_duplicates", "e1_standard_scaling", "e2_one_hot",
    "f7_temporal_features", "hourly_profile_of_cleaned", "i1_interpolate_series", "k1_top_rows", "l1_intents", "l3_last_turns",
    "m4_regression_metrics", "m5_metrics_by_segment", "m11_compare_models", "o1_cap_outliers", "o4_iqr_report",
    "o6_zscore_report", "r1_numeric_drift", "r2_categorical_drift", "r10_trend_report", "ts1_decompose", "ts2_strengths",
    "ts5_autocorrelation", "ts7_pack_series", "ts10_context_windows", "ts11_backtest", "v1_null_profile", "v5_range_report",
    "v10_cell_match", "v15_split_report", "x1_stratified_split", "x2_temporal_split", "x6_kfold", "m1_boosted_trees",
    "m9_batch_scoring",
]


def main() -> None:
    from pyspark.sql import SparkSession

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="wattspan-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from wattspan.plans.queries import QUERIES

    names = sys.argv[1:] or HEADLINE
    run = lambda n: QUERIES[n](spark, sf).write.format("noop").mode("overwrite").save()
    # The first runs load classes; they are not timed.
    for n in ("a1_grouped_stats", "o1_cap_outliers", "i1_interpolate_series"):
        run(n)
    times = {}
    for n in names:
        start = time.perf_counter()
        run(n)
        times[n] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
