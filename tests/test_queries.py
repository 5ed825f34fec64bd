"""Registered queries against their SQL on DuckDB. A spread by default, all of them with WATTSPAN_ALL=1."""

import os

import pytest

import __spark_entry__ as entry
from check_oracle import duck, run

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
SPREAD = [
    "a1_grouped_stats", "a8_numeric_summary", "a17_box_summary", "c6_mutual_information", "cleaning_job", "d1_keep_first",
    "e5_preprocessing_saved", "f7_temporal_features", "i1_interpolate_series", "l1_intents", "m11_compare_models", "o4_iqr_report",
    "p5_clean_categories", "r1_numeric_drift", "r10_trend_report", "s9_prediction_log", "ts1_decompose", "ts11_backtest",
    "v5_range_report", "v15_split_report", "x1_stratified_split", "z1_window_statistics", "z2_stream_validation",
    "a8_quartiles_infinity", "a16_histogram_nan", "e2_category_index", "j4_set_difference", "l1_intent_counts", "l2_slots",
    "m1_one_tree", "m8_residual_correlation", "o6_zscore_report_nan", "p6_map_values_table", "r6_alert", "s11_history_scan",
    "s12_retention", "ts1_decompose_spike", "ts6_partial_autocorrelation", "x1_stratified_split_category",
    "x1_stratified_split_nulls", "z3_stream_drift", "s12_remove_expired", "ts1_loess", "m3_one_tree_search",
    "c4_correlation_matrix", "c4_pairwise_complete", "e2_table_encoder", "m1_ordered_target", "m1_target_scoring", "r1_merged_runs",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(ORACLES) if os.environ.get("WATTSPAN_ALL") else SPREAD)
def test_query(spark, con, name):
    rows, difference = run(spark, con, SF, name, QUERIES, ORACLES)
    assert rows > 0 and difference is None, difference


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
