"""End-to-end jobs (E1-E8) composed from the operators."""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from daycast import schema as S
from daycast.operators import metrics as M
from daycast.operators import patterns as PT
from daycast.operators import prepare as P
from daycast.operators import scenario as SC
from daycast.operators import splits as SP
from daycast.operators.daily import build_daily_features  # noqa: F401  (E2)
from daycast.operators.prepare import prepare_visits  # noqa: F401  (E1)
from daycast.plans import forecast as FC
from daycast.plans import models as MD
from daycast.plans import tuning as TU
from daycast.session import materialize
from daycast.sources import readers as R


def prepare_model_input(df: DataFrame, date_col: str = S.DATE, approx: bool = False, group_cols=()) -> DataFrame:
    """Date parsed, text columns that should be numbers cast, month / weekday as int,
    numerics median-imputed, text mode-imputed -- per series; keys and calendar parts never."""
    if date_col in df.columns and dict(df.dtypes)[date_col] not in ("date",):
        df = df.withColumn(date_col, F.to_date(R._as_timestamp(df, date_col)))
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)} - set(group_cols)
    df = df.withColumns({c: F.trim(c).try_cast("double") for c in S.NUMERIC_COLUMNS if c in text})
    df = P.cast_int(df, [c for c in ("month", "dayOfWeek") if c in df.columns])
    return P.impute_by_type(df, exclude=(date_col,), approx=approx, group_cols=group_cols)


def default_features(df: DataFrame) -> list[str]:
    return [f for f in S.DEFAULT_FEATURES if f in df.columns]


@dataclass
class TrainResult:
    model: MD.ForecastModel
    test_metrics: DataFrame
    importances: DataFrame
    cv_metrics: DataFrame | None = None
    best_params: dict | None = None
    paths: dict | None = None
    results_path: str | None = None


def read_visits(spark: SparkSession, path: str, schema=None, names: dict[str, str] | None = None) -> DataFrame:
    """Visits from a CSV, parquet or JSON table with its dates parsed: columns named like dates, and the arrival and departure of ``names``."""
    raw = R.coerce_date_columns(R.read_by_extension(spark, path, schema, None))
    named = [c for k, c in (names or {}).items() if k in ("arrival", "departure") and c in raw.columns]
    return raw.withColumns({c: R._as_timestamp(raw, c) for c in named}) if named else raw


def train_from_visits(spark: SparkSession, path: str, output_dir: str, group_cols=(), schema=None,
                      names: dict[str, str] | None = None, **options) -> TrainResult:
    """Visits file -> dates parsed -> daily features, written -> models, metadata and results file.

    ``path`` is a CSV, parquet or JSON table of visits. The daily table goes to
    ``output_dir/processed``, models and results to ``output_dir/models``.
    """
    raw = read_visits(spark, path, schema, names)
    R.write_json_result(P.visit_quality(raw, names, group_cols), f"{output_dir}/processed", "visit_quality")
    daily = build_daily_features(raw, group_cols, names)
    written = R.write_table(daily, f"{output_dir}/processed")
    return train(spark.read.parquet(written), group_cols=group_cols, model_dir=f"{output_dir}/models", **options)


def train(daily: DataFrame, features=None, test_size: float = 0.2, split: str = "time",
          optimize: bool = False, cross_validation: bool = False, n_splits: int = 5,
          admission_params: dict | None = None, occupancy_params: dict | None = None,
          admission_grid: dict | None = None, occupancy_grid: dict | None = None,
          model_dir: str | None = None, group_cols=(), seed: int = 42, approx: bool = False) -> TrainResult:
    """Prepare, split, optionally tune (the best parameters are used), fit both
    models, evaluate on the held-out part, set the alert thresholds (per series),
    save models and results. ``approx`` takes medians and quartiles from a sketch."""
    df = prepare_model_input(daily, approx=approx, group_cols=group_cols)
    features = list(features or default_features(df))
    df = P.default_missing_columns(df, features, "lags")
    if split == "random":
        labelled = SP.random_split(df, test_size, seed, group_cols=group_cols, label="_split")
    else:
        # One model for all series: one date cuts them all.
        labelled = SP.split_by_time(df, test_size, group_cols, label="_split", common=bool(group_cols))
    labelled = labelled.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _train(labelled, features, optimize, cross_validation, n_splits, admission_params, occupancy_params,
                      admission_grid, occupancy_grid, model_dir, tuple(group_cols), approx)
    finally:
        labelled.unpersist()


def _train(labelled: DataFrame, features, optimize, cross_validation, n_splits, admission_params, occupancy_params,
           admission_grid, occupancy_grid, model_dir, group_cols, approx) -> TrainResult:
    spark = labelled.sparkSession
    train_df = labelled.where(F.col("_split") == "train").drop("_split")
    test_df = labelled.where(F.col("_split") == "test").drop("_split")
    adm_params, occ_params = dict(admission_params or {}), dict(occupancy_params or {})
    best = None
    if optimize:
        adm_best, _ = TU.grid_search(train_df, features, "admissions", admission_grid, n_splits, group_cols=group_cols)
        occ_best, _ = TU.grid_search(train_df, features, "occupancy", occupancy_grid, n_splits, group_cols=group_cols)
        adm_params.update(adm_best)
        occ_params.update(occ_best)
        best = {"admissions": adm_best, "occupancy": occ_best}
    adm = MD.fit_admissions(train_df, features, **adm_params)
    occ = MD.fit_occupancy(train_df, features, **occ_params)
    thr = M.iqr_threshold(train_df, S.ADMISSIONS, group_cols=group_cols, approx=approx)
    if group_cols:
        table = materialize(thr.select(*group_cols, "threshold"), "thresholds")
        model = MD.ForecastModel(adm, occ, features, None, series_thresholds=table, series_cols=group_cols)
    else:
        model = MD.ForecastModel(adm, occ, features, thr.first()["threshold"])
    model.metrics = MD.metrics_dict(MD.evaluate_model(model, train_df))
    # Written once: the held-out rows are scored here and never again.
    test_metrics = materialize(MD.evaluate_model(model, test_df), "test-metrics")
    cv = None
    if cross_validation:
        _, cv = TU.cross_validate(train_df, features, n_splits, adm_params, occ_params, group_cols)
    paths = MD.save_model(model, spark, model_dir) if model_dir else None
    importances = MD.top_importances(MD.feature_importances(model, spark), 10)
    results = _write_results(spark, model, test_metrics, best, paths, model_dir) if model_dir else None
    return TrainResult(model, test_metrics, importances, cv, best, paths, results)


def _write_results(spark: SparkSession, model: MD.ForecastModel, test_metrics: DataFrame, best, paths, directory: str) -> str:
    """One JSON row with the run's metrics, tuned parameters and model paths."""
    row = (model.timestamp, json.dumps(model.metrics), json.dumps(MD.metrics_dict(test_metrics)), json.dumps(best), json.dumps(paths))
    df = spark.createDataFrame([row], "timestamp string, train_metrics string, test_metrics string, best_params string, model_paths string")
    stamp = _dt.datetime.now().strftime("%Y%m%d_%H%M%S")
    return R.write_json_result(df.coalesce(1), directory, f"training_results_{stamp}")


def load_history(spark: SparkSession, source, end=None, order_col: str | None = None, group_cols=()) -> DataFrame:
    """History for a forecast: a DataFrame, a table path (by extension) or a directory (newest table).
    Without a ``date`` column, consecutive days ending at ``end`` are attached to each series (S9)."""
    if isinstance(source, DataFrame):
        df = source
    elif str(source).lower().endswith((".csv", ".parquet", ".json")):
        df = R.read_by_extension(spark, source)
    else:
        df = R.read_latest(spark, source)
    if S.DATE not in df.columns:
        if end is None or order_col is None:
            raise ValueError("a history without a date column needs an explicit end date and order column")
        df = R.attach_daily_dates(df, end, order_col, group_cols)
    return df.withColumn(S.DATE, F.to_date(R._as_timestamp(df, S.DATE)))


def predict_entries(model: MD.ForecastModel, entries: DataFrame, group_cols=()) -> dict[str, DataFrame]:
    """Predictions and alerts of single days given by hand: features an entry table lacks take their defaults."""
    scored = MD.predict(model, P.default_missing_columns(entries, model.feature_names, "entry"))
    alerts = model.alerts(scored, group_cols) if S.DATE in entries.columns else None
    return {"predictions": scored, "alerts": alerts}


def forecast(spark: SparkSession, history, model, days: int = 30, group_cols=(), end=None,
             order_col: str | None = None, output_dir: str | None = None,
             lag_mode: str = "reference") -> dict[str, DataFrame]:
    """E5: load model and history, forecast recursively, raise alerts, build chart
    data and a summary; optionally write predictions (parquet) and alerts /
    summary (JSON)."""
    if not isinstance(model, MD.ForecastModel):
        model = MD.load_latest_model(spark, model)
    hist = load_history(spark, history, end, order_col, group_cols)
    hist = P.default_missing_columns(hist, model.feature_names, mode="history")
    # Written once: alerts, chart, summary and files read it.
    fc = materialize(FC.forecast_recursive(model, hist, days, group_cols, lag_mode), "forecast")
    alerts = model.alerts(fc, group_cols)
    chart = FC.history_with_forecast(model, hist, fc, 50, group_cols)
    summary = M.forecast_summary(fc, group_cols)
    if output_dir:
        stamp = _dt.datetime.now().strftime("%Y%m%d_%H%M%S")
        paths = {"predictions": R.write_table(fc, output_dir, f"predictions_{stamp}"), "alerts": R.write_json_result(alerts, output_dir, f"alerts_{stamp}"),
                 "summary": R.write_json_result(summary, output_dir, f"summary_{stamp}")}
        # Written last: the run's model, period and files.
        run = fc.agg(F.min(S.DATE).alias("first_day"), F.max(S.DATE).alias("last_day"), F.count_distinct(S.DATE).alias("days")).withColumns({
            "model_version": F.lit(model.model_version), "model_timestamp": F.lit(model.timestamp), "paths": F.lit(json.dumps(paths)), "created": F.lit(stamp)})
        R.write_json_result(run.coalesce(1), output_dir, f"run_{stamp}")
    return {"forecast": fc, "alerts": alerts, "chart": chart, "summary": summary}


def validate(model: MD.ForecastModel, daily: DataFrame, test_size: float = 0.2, group_cols=(),
             bins: int = 10, gridsize: int = 200, output_dir: str | None = None, approx: bool = False) -> dict[str, DataFrame]:
    """Time-ordered hold-out, predictions, extended metrics, residuals and
    their distribution (histogram and kernel density per target)."""
    df = P.default_missing_columns(prepare_model_input(daily, approx=approx, group_cols=group_cols), model.feature_names, "lags")
    _, test = SP.train_test(df, test_size, group_cols, common=bool(group_cols))
    scored = materialize(MD.predict(model, test), "validation")
    metrics = M.extended_metrics(scored, MD.prediction_pairs(), group_cols)
    res = scored.select(*group_cols, S.DATE, F.inline(F.array(
        F.struct(F.lit("admissions").alias("target"), F.col(S.ADMISSIONS).cast("double").alias("actual"),
                 F.col(MD.PRED_ADM).alias("predicted")),
        F.struct(F.lit("occupancy").alias("target"), F.col(S.OCCUPANCY).cast("double").alias("actual"),
                 F.col(MD.PRED_OCC).alias("predicted")),
    ))).withColumn("residual", F.col("actual") - F.col("predicted"))
    keys = [*group_cols, "target"]
    hist = M.residual_histogram(res, "residual", bins, keys)
    dens = M.residual_density(res, "residual", gridsize, 0.0, keys)
    if output_dir:
        R.write_json_result(metrics, output_dir, "validation_metrics")
        for name, table in (("residuals", res), ("residual_histogram", hist), ("residual_density", dens)):
            R.write_table(table, output_dir, f"validation_{name}")
    return {"metrics": metrics, "residuals": res, "histogram": hist, "density": dens}


def seasonal_patterns(daily: DataFrame, group_cols=()) -> dict[str, DataFrame]:
    """E7."""
    P.require_columns(daily, ["month", "dayOfWeek", S.ADMISSIONS, S.OCCUPANCY])
    return PT.seasonal_patterns(daily, group_cols=group_cols)


def scenario(series: DataFrame, intervals: DataFrame, *factors, **options) -> DataFrame:
    """See ``operators.scenario.scenario``; all factors are the caller's."""
    return SC.scenario(series, intervals, *factors, **options)
