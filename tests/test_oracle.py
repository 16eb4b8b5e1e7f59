"""Registered queries against their DuckDB oracle on the smallest tables (the
driver runs the full set at sf0.01; see tests/oracle_check.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
NAMES = ["build_daily_features", "build_daily_features_events", "impute_median", "alert_rows",
         "seasonal_pattern", "time_series_folds", "extended_metrics", "residual_density",
         "interval_uplift", "scenario", "calendar_factor_events", "forecast_seed_events", "daily_updates_events",
         "visit_quality", "impute_median_events", "iqr_threshold_events", "densify_daily_gappy", "random_split",
         "forecast_linear", "fold_metrics_naive", "csv_round_trip", "tree_nodes", "predict_trees", "importances_trees",
         "cross_validate_trees", "grid_search_trees", "model_round_trip", "predict_entries", "read_visits", "prepare_model_input"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, rows)[0] == digest(ocols, res.fetchall())[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "totalAdmissions" in df.columns


def test_only_fitted_trees_go_without_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    plain = {k for k in q if k not in o and k != "pipeline" and not k.startswith("op")}
    assert plain == {"train_metrics", "feature_importances", "predict", "forecast_job", "validate", "cross_validate", "grid_search", "grid_search_occupancy",
                     "forecast_summary", "forecast_alerts", "history_with_forecast", "forecast_recursive", "forecast_events"}
