"""Every registered query against its oracle on the smallest tables, with both ordered-group routes."""

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

import __spark_entry__ as entry  # noqa: E402
from compare import differences, oracle_connection  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
ORDERED = [
    "median_impute_global", "median_impute_fitted", "parse_datetime_sort", "box_stats", "cv_summary", "lag_features", "rolling_features",
    "centered_moving_avg", "time_split", "lookback_sequences", "aq_feature_table", "stratified_split", "stratified_folds", "roc_auc_ovr",
    "roc_curve_macro",
]


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, SF_DIR)
    if name in entry.oracle_sql():
        assert differences(df, oracle, entry.oracle_sql()[name]) == []
    else:
        assert df.count() > 0


@pytest.mark.parametrize("name", ORDERED)
def test_query_with_large_groups(spark, oracle, small_groups, name):
    assert differences(entry.queries()[name](spark, SF_DIR), oracle, entry.oracle_sql()[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "reading_roll_mean_168" in df.columns
