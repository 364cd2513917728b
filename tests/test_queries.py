"""Registered queries against their SQL on the smallest tables, and the driver contract."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from chronogrid.plans.catalog import ORACLES, QUERIES
from tools.check import connect, rows_of

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "w3_lags", "w9_fill_when_probe_missing", "w12_runs", "w14_priority_dedupe", "j1_full_outer_by_time", "j7_vacation_range_join",
    "j12_as_of_daily", "t3_impute_long_gaps", "t5_impute_direction", "t8_holiday_calendar", "a5_grouping_sets", "a12_describe",
    "x6_parse_several_formats", "x8_utc_to_local", "x14_quantile_bins", "x16_tied_edges_fallback", "c2_welch_test", "e1_metrics",
    "e12_feature_profile", "m4_backtest_windows", "m5_linear_candidate", "m7_best_ensemble", "s3_many_files_newest_wins",
    "s14_electricity_price_files", "k3_dated_snapshots", "v9_regime_spans", "r3_sessions", "r4_redelivered_rows",
]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


def test_every_query_has_sql_or_is_known_to_have_none():
    without = set(QUERIES) - set(ORACLES)
    assert without == {
        "c3_bootstrap_band", "c5_repeatable_sample", "g2_train_leaderboard", "g3_prediction_job", "k9_feature_importance",
        "m10_permutation_importance", "m11_saved_model", "m12_operational_prediction", "m5_boosted_trees_candidate",
        "m8_quantile_regression",
    }
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = connect(FOLDER).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())
