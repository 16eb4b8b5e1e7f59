"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They run the library's operators over the driver tables: the orders view (one
series) and the events view (one series per event type). Double outputs are
rounded to 6 decimals so that results can be compared by value hash.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from daycast import schema as S
from daycast.functions import columns as C
from daycast.operators import daily as D
from daycast.operators import prepare as P
from daycast.session import materialize, scratch_path
from daycast.sources import tables as T

ROUND = 6
EVENT_SERIES = ("event_type",)


def rounded(df: DataFrame, decimals: int = ROUND) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({c: F.round(c, decimals) for c in doubles}) if doubles else df


# -- shared building blocks -------------------------------------------------

def orders_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.prepare_visits(T.visits_from_orders(spark, sf_dir))


def events_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.prepare_visits(T.visits_from_events(spark, sf_dir))


def orders_daily(spark, sf_dir) -> DataFrame:
    return D.aggregate_daily(P.enrich_visits(T.visits_from_orders(spark, sf_dir)), impute=True)


def orders_dense(spark, sf_dir) -> DataFrame:
    return D.densify_daily(orders_daily(spark, sf_dir))


def orders_features(spark, sf_dir) -> DataFrame:
    return D.build_daily_features(T.visits_from_orders(spark, sf_dir))


def events_features(spark, sf_dir) -> DataFrame:
    return D.build_daily_features(T.visits_from_events(spark, sf_dir), EVENT_SERIES)


# -- queries ----------------------------------------------------------------

VISIT_OUT = ["Patient", "waitingHours", "stayDuration", "occupancyRate", "isEmergency", "needsICU",
             "arrivalDay", "arrivalMonth", "arrivalYear", "arrivalDayOfWeek", "isWeekend",
             "isSummer", "isWinter", "isSpring", "isFall"]


def q_prepare_visits(spark, sf_dir):
    v = orders_visits(spark, sf_dir)
    return rounded(v.select(*VISIT_OUT, F.to_date(F.col(S.VISIT_COLUMNS["arrival"])).alias("arrivalDate")))


def q_aggregate_daily(spark, sf_dir):
    return rounded(orders_daily(spark, sf_dir))


def q_densify_daily(spark, sf_dir):
    return rounded(orders_dense(spark, sf_dir))


def q_forward_fill(spark, sf_dir):
    return rounded(D.forward_fill(orders_dense(spark, sf_dir)))


def q_backward_fill(spark, sf_dir):
    return rounded(D.backward_fill(orders_dense(spark, sf_dir)))


def q_build_daily_features(spark, sf_dir):
    return rounded(orders_features(spark, sf_dir))


def q_build_daily_features_events(spark, sf_dir):
    return rounded(events_features(spark, sf_dir))


QUERIES = {
    "prepare_visits": q_prepare_visits,
    "aggregate_daily": q_aggregate_daily,
    "densify_daily": q_densify_daily,
    "forward_fill": q_forward_fill,
    "backward_fill": q_backward_fill,
    "build_daily_features": q_build_daily_features,
    "build_daily_features_events": q_build_daily_features_events,
}


# -- imputation, profiling, bounds --------------------------------------------
from daycast.operators import alerts as AL  # noqa: E402
from daycast.operators import metrics as M  # noqa: E402
from daycast.operators import patterns as PT  # noqa: E402
from daycast.operators import scenario as SC  # noqa: E402
from daycast.operators import splits as SP  # noqa: E402
from daycast.sources import readers as R  # noqa: E402


def q_impute_median(spark, sf_dir):
    return rounded(P.impute_median(orders_dense(spark, sf_dir), S.FFILL_COLUMNS))


def q_impute_mode(spark, sf_dir):
    return rounded(P.impute_mode(orders_dense(spark, sf_dir), S.FFILL_COLUMNS))


def q_null_counts(spark, sf_dir):
    return P.null_counts(orders_dense(spark, sf_dir))


def q_date_bounds(spark, sf_dir):
    return P.date_bounds(T.visits_from_events(spark, sf_dir), S.VISIT_COLUMNS["arrival"], EVENT_SERIES)


def q_distinct_days(spark, sf_dir):
    return D.distinct_days(T.visits_from_orders(spark, sf_dir))


def q_tail_by_date(spark, sf_dir):
    return rounded(D.tail_by_date(orders_features(spark, sf_dir), 50))


def q_iqr_threshold(spark, sf_dir):
    thr = M.iqr_threshold(orders_features(spark, sf_dir), S.ADMISSIONS)
    return thr.withColumn("occupancy_threshold", F.lit(S.OCCUPANCY_THRESHOLD))


def history_alert_rules(threshold_col: str = "threshold"):
    return AL.default_rules(threshold_col, S.OCCUPANCY_THRESHOLD, S.ADMISSIONS, S.OCCUPANCY)


def with_admission_threshold(features: DataFrame, group_cols=()) -> DataFrame:
    thr = M.iqr_threshold(features, S.ADMISSIONS, group_cols=group_cols).select(*group_cols, "threshold")
    return M.attach_stats(features, thr, group_cols)


def q_alert_rows(spark, sf_dir):
    f = with_admission_threshold(orders_features(spark, sf_dir))
    return rounded(AL.alert_rows(f, history_alert_rules()))


def q_flag_alerts(spark, sf_dir):
    f = with_admission_threshold(events_features(spark, sf_dir), EVENT_SERIES)
    out = AL.flag_alerts(f, history_alert_rules())
    return out.select(*EVENT_SERIES, S.DATE, "admission_alert", "occupancy_alert")


def q_monthly_pattern(spark, sf_dir):
    return rounded(PT.monthly_pattern(orders_features(spark, sf_dir)))


def q_weekly_pattern(spark, sf_dir):
    return rounded(PT.weekly_pattern(orders_features(spark, sf_dir)))


def q_seasonal_pattern(spark, sf_dir):
    return rounded(PT.seasonal_pattern(orders_features(spark, sf_dir)))


def q_weekend_pattern(spark, sf_dir):
    return rounded(PT.weekend_pattern(orders_features(spark, sf_dir)))


def q_weekly_pattern_events(spark, sf_dir):
    return rounded(PT.weekly_pattern(events_features(spark, sf_dir), group_cols=EVENT_SERIES))


# -- splits --------------------------------------------------------------------

def q_split_by_time(spark, sf_dir):
    out = SP.split_by_time(orders_features(spark, sf_dir), 0.2)
    return out.select(S.DATE, S.ADMISSIONS, "split")


def q_split_by_time_events(spark, sf_dir):
    out = SP.split_by_time(events_features(spark, sf_dir), 0.2, EVENT_SERIES)
    return out.select(*EVENT_SERIES, S.DATE, "split")


def q_time_series_folds(spark, sf_dir):
    out = SP.time_series_folds(orders_features(spark, sf_dir), 5)
    return out.select(S.DATE, F.col("_row").cast("bigint").alias("row_index"), "test_fold")


def q_random_split(spark, sf_dir):
    out = SP.random_split(orders_features(spark, sf_dir), 0.2, 42)
    return out.select(S.DATE, "split")


# -- metrics on a naive lag-7 forecast (stand-in for model output) ------------

NAIVE_PAIRS = {"admissions": (S.ADMISSIONS, "admissionsLag7"), "occupancy": (S.OCCUPANCY, "occupancyLag7")}


def naive_test_part(spark, sf_dir) -> DataFrame:
    _, test = SP.train_test(orders_features(spark, sf_dir), 0.2)
    return test


def q_regression_metrics(spark, sf_dir):
    return rounded(M.regression_metrics(orders_features(spark, sf_dir), NAIVE_PAIRS))


def q_regression_metrics_events(spark, sf_dir):
    return rounded(M.regression_metrics(events_features(spark, sf_dir), NAIVE_PAIRS, EVENT_SERIES))


def q_extended_metrics(spark, sf_dir):
    return rounded(M.extended_metrics(naive_test_part(spark, sf_dir), NAIVE_PAIRS))


def q_residuals(spark, sf_dir):
    out = M.residuals(naive_test_part(spark, sf_dir), S.ADMISSIONS, "admissionsLag7")
    return rounded(out.select(S.DATE, "residual"))


def q_residual_histogram(spark, sf_dir):
    r = M.residuals(orders_features(spark, sf_dir), S.ADMISSIONS, "admissionsLag7")
    return rounded(M.residual_histogram(r, "residual", bins=10))


def q_residual_density(spark, sf_dir):
    r = M.residuals(naive_test_part(spark, sf_dir), S.ADMISSIONS, "admissionsLag7")
    return rounded(M.residual_density(r, "residual", gridsize=200))


def q_residual_density_events(spark, sf_dir):
    r = M.residuals(events_features(spark, sf_dir), S.OCCUPANCY, "occupancyLag1")
    return rounded(M.residual_density(r, "residual", gridsize=50, group_cols=EVENT_SERIES))


# -- scenario overlays ------------------------------------------------------------

def q_zscore(spark, sf_dir):
    out = SC.zscore(orders_features(spark, sf_dir), S.ADMISSIONS, 3.0)
    return rounded(out.select(S.DATE, "zscore"))


def q_calendar_factor(spark, sf_dir):
    """Each month's and weekday's share of the series' mean, at most 19 numbers, as the factors of all days."""
    f = orders_features(spark, sf_dir)
    found = {}
    for r in SC.calendar_means(f).collect():
        found.setdefault(r["part"], {})[r["key"]] = r["factor"]
    out = SC.calendar_scale(f, C.calendar_factor(S.DATE, found["month"], found["weekday"]))
    return rounded(out.select(S.DATE, "calendarFactor", "scenarioAdmissions"))


def q_calendar_factor_events(spark, sf_dir):
    """P19 for many series, each with the factors of its own days."""
    f = SC.observed_factor(events_features(spark, sf_dir), group_cols=EVENT_SERIES)
    out = SC.calendar_scale(f, F.col("calendarFactor"))
    return rounded(out.select(*EVENT_SERIES, S.DATE, "calendarFactor", "scenarioAdmissions"))


def with_peak_factors(features: DataFrame, group_cols=()) -> DataFrame:
    """The features with their series' alert threshold and the factors of the days that reach it."""
    f = with_admission_threshold(materialize(features, "features"), group_cols)
    return M.attach_stats(f, SC.peak_factors(f, "threshold", group_cols=group_cols), group_cols)


def uplifted(series: DataFrame, group_cols=()) -> DataFrame:
    intervals = SC.peak_intervals(series, S.ADMISSIONS, "threshold", 7, group_cols)
    return SC.interval_uplift(series, intervals, F.col("adm_factor"), F.col("occ_factor"), F.col("hi"), group_cols)


def q_interval_uplift(spark, sf_dir):
    out = uplifted(with_peak_factors(orders_features(spark, sf_dir)))
    return rounded(out.select(S.DATE, "peaks", "totalAdmissionsPeak", "avgOccupancyRatePeak"))


def q_interval_uplift_events(spark, sf_dir):
    out = uplifted(with_peak_factors(events_features(spark, sf_dir), EVENT_SERIES), EVENT_SERIES)
    return rounded(out.select(*EVENT_SERIES, S.DATE, "peaks", "totalAdmissionsPeak", "avgOccupancyRatePeak"))


def q_scenario(spark, sf_dir):
    """E8 with the series' own calendar, peaks, bounds and spread."""
    f = SC.observed_factor(with_peak_factors(orders_features(spark, sf_dir)))
    intervals = SC.peak_intervals(f, S.ADMISSIONS, "threshold", 7)
    out = SC.scenario(f, intervals, *[F.col(c) for c in ("calendarFactor", "adm_factor", "occ_factor", "lo", "hi", "spread")])
    return rounded(out.select(S.DATE, "scenarioAdmissions", "scenarioOccupancy", "peaks",
                              "scenarioAdmissionsPeak", "scenarioOccupancyPeak"))


# -- dates -------------------------------------------------------------------------

def q_attach_daily_dates(spark, sf_dir):
    f = events_features(spark, sf_dir).select(*EVENT_SERIES, F.col(S.DATE).alias("observed"), S.ADMISSIONS)
    end = F.max("observed").over(Window.partitionBy(*EVENT_SERIES))  # last observed day per series
    out = R.attach_daily_dates(f, end, "observed", EVENT_SERIES)
    return rounded(out)


QUERIES.update({
    "impute_median": q_impute_median,
    "impute_mode": q_impute_mode,
    "null_counts": q_null_counts,
    "date_bounds": q_date_bounds,
    "distinct_days": q_distinct_days,
    "tail_by_date": q_tail_by_date,
    "iqr_threshold": q_iqr_threshold,
    "alert_rows": q_alert_rows,
    "flag_alerts": q_flag_alerts,
    "monthly_pattern": q_monthly_pattern,
    "weekly_pattern": q_weekly_pattern,
    "seasonal_pattern": q_seasonal_pattern,
    "weekend_pattern": q_weekend_pattern,
    "weekly_pattern_events": q_weekly_pattern_events,
    "split_by_time": q_split_by_time,
    "split_by_time_events": q_split_by_time_events,
    "time_series_folds": q_time_series_folds,
    "random_split": q_random_split,
    "regression_metrics": q_regression_metrics,
    "regression_metrics_events": q_regression_metrics_events,
    "extended_metrics": q_extended_metrics,
    "residuals": q_residuals,
    "residual_histogram": q_residual_histogram,
    "residual_density": q_residual_density,
    "residual_density_events": q_residual_density_events,
    "zscore": q_zscore,
    "calendar_factor": q_calendar_factor,
    "calendar_factor_events": q_calendar_factor_events,
    "interval_uplift": q_interval_uplift,
    "interval_uplift_events": q_interval_uplift_events,
    "scenario": q_scenario,
    "attach_daily_dates": q_attach_daily_dates,
})


# -- forecasting inputs (oracle-checked) ------------------------------------------------
from daycast.plans import forecast as FC  # noqa: E402


def q_future_calendar(spark, sf_dir):
    return FC.future_calendar(orders_features(spark, sf_dir), 30)


def q_future_calendar_events(spark, sf_dir):
    return FC.future_calendar(events_features(spark, sf_dir), 30, EVENT_SERIES)


def q_forecast_seed(spark, sf_dir):
    return rounded(FC.seed_features(FC.forecast_seed(orders_features(spark, sf_dir))))


def q_forecast_seed_events(spark, sf_dir):
    f = events_features(spark, sf_dir)
    return rounded(FC.seed_features(FC.forecast_seed(f, EVENT_SERIES), EVENT_SERIES))


QUERIES.update({
    "future_calendar": q_future_calendar,
    "future_calendar_events": q_future_calendar_events,
    "forecast_seed": q_forecast_seed,
    "forecast_seed_events": q_forecast_seed_events,
})


# -- models (rows-only: predictions come from Spark ML trees) -------------------------
from daycast.plans import jobs as J  # noqa: E402
from daycast.plans import models as MD  # noqa: E402
from daycast.plans import tuning as TU  # noqa: E402

_TRAINED: dict = {}


def _key(spark, sf_dir, *more):
    """One application and one version of the tables."""
    files = [spark.read.format("binaryFile").load(f"{sf_dir}/{t}.parquet").agg(F.max("modificationTime"), F.sum("length")).first()
             for t in ("orders", "lineitem", "events")]
    return (spark.sparkContext.applicationId, sf_dir, str(files), *more)


def trained(spark, sf_dir):
    """E4 with the default models on the orders series, fitted once per application and table."""
    key = _key(spark, sf_dir)
    if key not in _TRAINED:
        daily = materialize(J.prepare_model_input(orders_features(spark, sf_dir)), "model-input")
        _TRAINED[key] = (daily, J.train(daily))
    return _TRAINED[key]


def q_train_metrics(spark, sf_dir):
    return rounded(trained(spark, sf_dir)[1].test_metrics)


def q_feature_importances(spark, sf_dir):
    return rounded(trained(spark, sf_dir)[1].importances)


def q_predict(spark, sf_dir):
    daily, res = trained(spark, sf_dir)
    out = MD.predict(res.model, daily)
    return rounded(out.select(S.DATE, S.ADMISSIONS, S.OCCUPANCY, MD.PRED_ADM, MD.PRED_OCC,
                              "admission_alert", "occupancy_alert"))


def q_forecast_job(spark, sf_dir):
    daily, res = trained(spark, sf_dir)
    out = J.forecast(spark, daily, res.model, 30)
    return rounded(out["summary"])


def q_validate(spark, sf_dir):
    daily, res = trained(spark, sf_dir)
    return rounded(J.validate(res.model, daily)["metrics"])


def q_cross_validate(spark, sf_dir):
    """Both default models over five folds."""
    daily = materialize(J.prepare_model_input(orders_features(spark, sf_dir)), "model-input")
    per_fold, mean = TU.cross_validate(daily, J.default_features(daily), 5)
    folds = per_fold.select("fold").distinct().count()
    return rounded(mean.withColumn("folds", F.lit(folds).cast("long")))


def q_grid_search(spark, sf_dir):
    """The whole boosting grid, 27 candidates over five folds: one row per candidate and fold."""
    daily = materialize(J.prepare_model_input(orders_features(spark, sf_dir)), "model-input")
    return rounded(TU.grid_search(daily, J.default_features(daily), "admissions", None, 5)[1])


def q_grid_search_occupancy(spark, sf_dir):
    """The whole forest grid, 27 candidates over five folds: one row per candidate and fold."""
    daily = materialize(J.prepare_model_input(orders_features(spark, sf_dir)), "model-input")
    return rounded(TU.grid_search(daily, J.default_features(daily), "occupancy", None, 5)[1])


QUERIES.update({
    "train_metrics": q_train_metrics,
    "feature_importances": q_feature_importances,
    "predict": q_predict,
    "forecast_job": q_forecast_job,
    "validate": q_validate,
    "cross_validate": q_cross_validate,
    "grid_search": q_grid_search,
    "grid_search_occupancy": q_grid_search_occupancy,
})


# -- streaming -------------------------------------------------------------------------
from daycast.streaming import daily_updates as SU  # noqa: E402


def q_daily_updates_events(spark, sf_dir):
    """The events table read as a file stream; all days of each event type."""
    schema = T.load(spark, sf_dir, "events").schema

    def to_visits(raw):
        return raw.select(
            "event_type",
            F.col("event_id").alias(S.VISIT_COLUMNS["patient"]),
            F.col("ts").alias(S.VISIT_COLUMNS["arrival"]),
            F.concat(F.col("value").cast("string"), F.lit("%")).alias(S.VISIT_COLUMNS["occupancy"]),
        )

    return rounded(SU.run_daily_updates(spark, sf_dir, schema, "parquet", EVENT_SERIES, to_visits,
                                        glob="events.parquet"))


QUERIES["daily_updates_events"] = q_daily_updates_events


# -- single window operators and forecast summary -------------------------------------

_FORECASTS: dict = {}


def orders_filled(spark, sf_dir) -> DataFrame:
    return D.forward_fill(orders_dense(spark, sf_dir))


def q_lag_features(spark, sf_dir):
    """W1 + W2 on the filled daily series."""
    f = orders_filled(spark, sf_dir)
    out = f.select(
        S.DATE,
        *[D.lag_zero(S.ADMISSIONS, n).alias(f"admissionsLag{n}") for n in S.LAGS],
        *[D.lag(S.OCCUPANCY, n).alias(f"occupancyLag{n}") for n in S.LAGS],
    )
    return rounded(D.backward_fill(out, [f"occupancyLag{n}" for n in S.LAGS]))


def q_rolling_mean(spark, sf_dir):
    """7-day means with and without the current day."""
    f = orders_filled(spark, sf_dir)
    return rounded(f.select(
        S.DATE,
        D.rolling_mean(S.ADMISSIONS).alias("admissionsMA7"),
        D.rolling_mean(S.OCCUPANCY).alias("occupancyMA7"),
        D.rolling_mean(S.ADMISSIONS, include_current=False).alias("admissionsMA7Prev"),
    ))


def forecast_table(spark, sf_dir):
    """The 30-day forecast of the trained model, written once per application and table."""
    key = _key(spark, sf_dir)
    if key not in _FORECASTS:
        daily, res = trained(spark, sf_dir)
        _FORECASTS[key] = materialize(FC.forecast_recursive(res.model, daily, 30), "forecast")
    return _FORECASTS[key]


def q_forecast_summary(spark, sf_dir):
    return rounded(M.forecast_summary(forecast_table(spark, sf_dir)))


def q_forecast_alerts(spark, sf_dir):
    _, res = trained(spark, sf_dir)
    return rounded(res.model.alerts(forecast_table(spark, sf_dir)))


def q_history_with_forecast(spark, sf_dir):
    daily, res = trained(spark, sf_dir)
    return rounded(FC.history_with_forecast(res.model, daily, forecast_table(spark, sf_dir), 50))


def q_forecast_recursive(spark, sf_dir):
    return rounded(forecast_table(spark, sf_dir))


QUERIES.update({
    "lag_features": q_lag_features,
    "rolling_mean": q_rolling_mean,
    "forecast_summary": q_forecast_summary,
    "forecast_alerts": q_forecast_alerts,
    "history_with_forecast": q_history_with_forecast,
    "forecast_recursive": q_forecast_recursive,
})


# -- multi-series daily steps ------------------------------------------------------------

def events_daily(spark, sf_dir) -> DataFrame:
    return D.aggregate_daily(P.enrich_visits(T.visits_from_events(spark, sf_dir)), EVENT_SERIES, impute=True)


def q_aggregate_daily_events(spark, sf_dir):
    return rounded(events_daily(spark, sf_dir))


def q_densify_daily_events(spark, sf_dir):
    return rounded(D.densify_daily(events_daily(spark, sf_dir), EVENT_SERIES))


QUERIES.update({
    "aggregate_daily_events": q_aggregate_daily_events,
    "densify_daily_events": q_densify_daily_events,
})


# -- many series at once (rows-only) ---------------------------------------------------------

def q_forecast_events(spark, sf_dir):
    """One model over every event type's daily series, then a 30-day forecast of all series
    in the same horizon steps."""
    key = _key(spark, sf_dir, "events")
    if key not in _FORECASTS:
        daily = materialize(J.prepare_model_input(events_features(spark, sf_dir), group_cols=EVENT_SERIES), "model-input")
        res = J.train(daily, group_cols=EVENT_SERIES)
        _FORECASTS[key] = materialize(FC.forecast_recursive(res.model, daily, 30, EVENT_SERIES), "forecast-events")
    return rounded(_FORECASTS[key])


QUERIES["forecast_events"] = q_forecast_events


# -- series with missing values and a null key ---------------------------------------------

def gappy_events(spark, sf_dir) -> DataFrame:
    """The events with some values missing, some undated, some with junk text, and one event type
    turned into a null key -- all by rule, so that SQL can follow."""
    v = S.VISIT_COLUMNS
    e = T.visits_from_events(spark, sf_dir)
    n = F.col(v["patient"])
    return e.select(
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type"),
        n.alias(v["patient"]),
        F.when(n % 97 != 0, F.col(v["arrival"])).alias(v["arrival"]),
        F.when(n % 5 == 0, F.lit(None)).when(n % 11 == 0, F.lit("n/a")).otherwise(F.col(v["occupancy"])).alias(v["occupancy"]),
        F.concat((n % 4).cast("string"), F.when(n % 13 == 0, F.lit(" ?")).otherwise(F.lit(" h"))).alias(v["waiting"]),
    )


def gappy_daily(spark, sf_dir) -> DataFrame:
    return D.aggregate_daily(P.enrich_visits(gappy_events(spark, sf_dir)), EVENT_SERIES, impute=True)


def q_visit_quality(spark, sf_dir):
    return P.visit_quality(gappy_events(spark, sf_dir), group_cols=EVENT_SERIES)


def q_aggregate_daily_gappy(spark, sf_dir):
    return rounded(gappy_daily(spark, sf_dir))


def q_impute_median_events(spark, sf_dir):
    """Raw visits, medians per event type, the null one included."""
    v = S.VISIT_COLUMNS
    out = P.prepare_visits(gappy_events(spark, sf_dir), group_cols=EVENT_SERIES)
    return rounded(out.select(*EVENT_SERIES, F.col(v["patient"]).alias("Patient"), "occupancyRate", "waitingHours"))


def q_impute_mode_events(spark, sf_dir):
    v = S.VISIT_COLUMNS
    e = P.enrich_visits(gappy_events(spark, sf_dir))
    e = e.withColumn("waitingHours", F.when(F.col(v["patient"]) % 7 != 0, F.col("waitingHours")))
    out = P.impute_mode(e, ["waitingHours"], EVENT_SERIES)
    return rounded(out.select(*EVENT_SERIES, F.col(v["patient"]).alias("Patient"), "waitingHours"))


def sparse_daily(spark, sf_dir) -> DataFrame:
    """Daily rows of the gappy events without every fourth day of the month."""
    return gappy_daily(spark, sf_dir).where(F.col("dayOfMonth") % 4 != 0)


def q_densify_daily_gappy(spark, sf_dir):
    return rounded(D.densify_daily(sparse_daily(spark, sf_dir), EVENT_SERIES))


def q_iqr_threshold_events(spark, sf_dir):
    return rounded(M.iqr_threshold(gappy_daily(spark, sf_dir), S.ADMISSIONS, group_cols=EVENT_SERIES))


def q_split_by_date_events(spark, sf_dir):
    """One date cuts all series."""
    out = SP.split_by_time(sparse_daily(spark, sf_dir), 0.2, EVENT_SERIES, common=True)
    return out.select(*EVENT_SERIES, S.DATE, "split")


def q_folds_by_date_events(spark, sf_dir):
    out = SP.time_series_folds(sparse_daily(spark, sf_dir), 5, EVENT_SERIES, common=True)
    return out.select(*EVENT_SERIES, S.DATE, "test_fold")


def q_zscore_constant(spark, sf_dir):
    """A constant series has no deviation."""
    out = SC.zscore(orders_features(spark, sf_dir).withColumn("one", F.lit(1.0)), "one", 3.0)
    return out.select(S.DATE, "zscore")


def q_fill_zero(spark, sf_dir):
    """W6 on counts emptied by rule."""
    f = events_features(spark, sf_dir).select(*EVENT_SERIES, S.DATE, F.when(F.col("dayOfMonth") % 3 != 0, F.col(S.ADMISSIONS)).alias(S.ADMISSIONS))
    return D.fill_zero(f)


def q_sort_by_date(spark, sf_dir):
    return rounded(D.sort_by_date(events_features(spark, sf_dir).select(*EVENT_SERIES, S.DATE, S.ADMISSIONS), EVENT_SERIES))


def q_select_features(spark, sf_dir):
    """The feature columns, summed so that each is read."""
    f = events_features(spark, sf_dir)
    names = P.select_features(f, group_cols=EVENT_SERIES)
    total = f.agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in names])
    return rounded(total.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.round(F.col(c), 3).alias("total")) for c in names]))))


def q_cast_int(spark, sf_dir):
    f = orders_features(spark, sf_dir)
    text = f.select(S.DATE, F.col("month").cast("string").alias("month"), F.col("dayOfWeek").cast("string").alias("dayOfWeek"))
    return P.cast_int(text)


QUERIES.update({
    "visit_quality": q_visit_quality,
    "aggregate_daily_gappy": q_aggregate_daily_gappy,
    "impute_median_events": q_impute_median_events,
    "impute_mode_events": q_impute_mode_events,
    "densify_daily_gappy": q_densify_daily_gappy,
    "iqr_threshold_events": q_iqr_threshold_events,
    "split_by_date_events": q_split_by_date_events,
    "folds_by_date_events": q_folds_by_date_events,
    "zscore_constant": q_zscore_constant,
    "fill_zero": q_fill_zero,
    "sort_by_date": q_sort_by_date,
    "select_features": q_select_features,
    "cast_int": q_cast_int,
})


# -- files ------------------------------------------------------------------------------------

def q_csv_round_trip(spark, sf_dir):
    """A daily table written as a CSV folder of parts, found as the newest table, all parts read back."""
    folder = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    daily = events_features(spark, sf_dir).select(*EVENT_SERIES, S.DATE, S.ADMISSIONS)
    R.write_table(daily.repartition(4, S.DATE), folder, "daily", "csv")
    back = R.read_latest(spark, folder, "event_type string, date string, totalAdmissions double")
    return back.withColumn(S.DATE, F.to_date(S.DATE))


def q_json_result(spark, sf_dir):
    """Threshold rows written as JSON lines and read by extension."""
    folder = scratch_path(spark, f"json-{uuid.uuid4().hex}")
    thr = rounded(M.iqr_threshold(events_features(spark, sf_dir), S.ADMISSIONS, group_cols=EVENT_SERIES))
    path = R.write_json_result(thr, folder, "thresholds.json")
    return R.read_by_extension(spark, path, "event_type string, q25 double, q75 double, threshold double")


def q_coerce_dates(spark, sf_dir):
    """Day-first and ISO text in a column named like a date."""
    v = S.VISIT_COLUMNS["arrival"]
    e = T.load(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "dd/MM/yyyy")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.lit("unknown"))
    out = R.coerce_date_columns(e.select("event_id", text.alias(v)))
    return out.select("event_id", F.to_date(F.col(v)).alias("day"))


QUERIES.update({"csv_round_trip": q_csv_round_trip, "json_result": q_json_result, "coerce_dates": q_coerce_dates})


# -- the forecasting rules on a fixed linear model ------------------------------------------------

def linear_model(threshold: float = 20.0, occupancy_threshold: float = 49.0) -> MD.ForecastModel:
    """Both targets from lag 1, lag 7 and the mean of the last days: a model SQL can follow."""
    def stage(prefix, out):
        return SQLTransformer(statement=f"SELECT *, 0.5D * {prefix}Lag1 + 0.2D * {prefix}Lag7 + 0.25D * {prefix}MA7Prev + 0.1D * dayOfWeek AS {out} FROM __THIS__")

    adm = PipelineModel(stages=[stage("admissions", MD.PRED_ADM)])
    occ = PipelineModel(stages=[stage("occupancy", MD.PRED_OCC)])
    names = [f"{t}{k}" for t in ("admissions", "occupancy") for k in ("Lag1", "Lag7", "MA7Prev")] + ["dayOfWeek"]
    return MD.ForecastModel(adm, occ, names, threshold, occupancy_threshold)


def linear_forecast(spark, sf_dir) -> DataFrame:
    return FC.forecast_recursive(linear_model(), events_features(spark, sf_dir), 10, EVENT_SERIES)


def q_forecast_linear(spark, sf_dir):
    out = linear_forecast(spark, sf_dir)
    return rounded(out.select(*EVENT_SERIES, S.DATE, "admissionsLag1", "admissionsLag3", "admissionsLag7", "admissionsMA7",
                              "occupancyLag1", "occupancyMA7", MD.PRED_ADM, MD.PRED_OCC, "admission_alert", "occupancy_alert"))


def q_forecast_summary_linear(spark, sf_dir):
    return rounded(M.forecast_summary(linear_forecast(spark, sf_dir), EVENT_SERIES))


def q_forecast_alerts_linear(spark, sf_dir):
    return rounded(linear_model().alerts(linear_forecast(spark, sf_dir), EVENT_SERIES))


def q_history_with_forecast_linear(spark, sf_dir):
    f = events_features(spark, sf_dir)
    out = FC.history_with_forecast(linear_model(), f, FC.forecast_recursive(linear_model(), f, 10, EVENT_SERIES), 12, EVENT_SERIES)
    return rounded(out)


def q_evaluate_linear(spark, sf_dir):
    return rounded(MD.evaluate_model(linear_model(), events_features(spark, sf_dir), EVENT_SERIES))


def q_validate_linear(spark, sf_dir):
    """E6 on the fixed model: metrics of the held-out days."""
    return rounded(J.validate(linear_model(), events_features(spark, sf_dir), 0.2, EVENT_SERIES)["metrics"])


def q_predict_linear(spark, sf_dir):
    out = MD.predict(linear_model(), orders_features(spark, sf_dir))
    return rounded(out.select(S.DATE, MD.PRED_ADM, MD.PRED_OCC, "admission_alert", "occupancy_alert"))


def q_fold_metrics_naive(spark, sf_dir):
    """The lag-7 forecast scored per fold, then averaged."""
    folds = SP.time_series_folds(orders_features(spark, sf_dir), 5).where("test_fold >= 0")
    return rounded(M.fold_metrics_mean(M.regression_metrics(folds, NAIVE_PAIRS, ["test_fold"])))


QUERIES.update({
    "forecast_linear": q_forecast_linear,
    "forecast_summary_linear": q_forecast_summary_linear,
    "forecast_alerts_linear": q_forecast_alerts_linear,
    "history_with_forecast_linear": q_history_with_forecast_linear,
    "evaluate_linear": q_evaluate_linear,
    "validate_linear": q_validate_linear,
    "predict_linear": q_predict_linear,
    "fold_metrics_naive": q_fold_metrics_naive,
})
