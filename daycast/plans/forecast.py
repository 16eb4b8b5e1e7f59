"""Future calendar and recursive multi-day forecast.

The forecast keeps **one state row per series**: the last seven actuals of
each target and the predictions made so far (array columns). Each horizon
step derives that day's features from the state with array expressions,
scores every series at once with both fitted pipelines, and appends the
predictions.

Fitted tree ensembles are walked as flat node arrays (``plans.trees``): all steps
of a batch of series run in one Arrow function, so a forecast is one pass over
the seed rows whatever the horizon. For other fitted pipelines the driver loops
over the steps; every step is a distributed scan, and the state is written into
the shared checkpoint folder every few steps so the plan does not grow with the horizon.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast import schema as S
from daycast.functions import columns as C
from daycast.operators.daily import series_window, tail_by_date
from daycast.operators.prepare import entry_default
from daycast.plans.models import PRED_ADM, PRED_OCC, ForecastModel, predict
from daycast.plans.trees import flat_trees
from daycast.session import materialize

HISTORY_DAYS = S.MA_WINDOW


def future_calendar(history: DataFrame, days: int = 30, group_cols=(), date_col: str = S.DATE) -> DataFrame:
    """M7: the ``days`` days after each series' last day, with calendar parts and flags."""
    last = history.groupBy(*group_cols).agg(F.max(F.to_date(date_col)).alias("_last"))
    out = last.select(*group_cols, F.posexplode(
        F.sequence(F.date_add("_last", 1), F.date_add("_last", int(days)))).alias("_i", date_col))
    return out.select(*group_cols, (F.col("_i") + 1).cast("int").alias("step"), date_col,
                      *[v.alias(k) for k, v in C.calendar_columns(date_col).items()])


def forecast_seed(history: DataFrame, group_cols=(), date_col: str = S.DATE,
                  admissions: str = S.ADMISSIONS, occupancy: str = S.OCCUPANCY) -> DataFrame:
    """T4: per series, its last day and the last seven values of both targets (oldest first)."""
    w = series_window(group_cols, date_col, descending=True)
    recent = history.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= HISTORY_DAYS)
    agg = recent.groupBy(*group_cols).agg(
        F.max(F.to_date(date_col)).alias("last_date"),
        F.sort_array(F.collect_list(F.struct(
            F.to_date(date_col).alias("d"),
            F.col(admissions).cast("double").alias("a"),
            F.col(occupancy).cast("double").alias("o"),
        ))).alias("_recent"),
    )
    return agg.select(
        *group_cols, "last_date",
        F.transform("_recent", lambda s: s["a"]).alias("y_adm"),
        F.transform("_recent", lambda s: s["o"]).alias("y_occ"),
    )


def seed_features(seed: DataFrame, group_cols=()) -> DataFrame:
    """The features of the first forecast day, from :func:`forecast_seed` output."""
    a = _step_lags(F.col("y_adm"), F.array(), 1, "reference")
    o = _step_lags(F.col("y_occ"), F.array(), 1, "reference")
    return seed.select(
        *group_cols, "last_date", F.size("y_adm").alias("n_history"),
        a["lag1"].alias("admissionsLag1"), a["lag3"].alias("admissionsLag3"), a["lag7"].alias("admissionsLag7"),
        a["ma"].alias("admissionsMA7"),
        o["lag1"].alias("occupancyLag1"), o["lag3"].alias("occupancyLag3"), o["lag7"].alias("occupancyLag7"),
        o["ma"].alias("occupancyMA7"),
    )


def _mean(arr: Column) -> Column:
    """Left-to-right sum / size (the order a Python loop would use)."""
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x) / F.size(arr)


def _last(arr: Column, m: int) -> Column:
    """The last ``m`` elements (all of them when there are fewer)."""
    return F.slice(arr, F.greatest(F.size(arr) - F.lit(m) + 1, F.lit(1)), F.lit(m))


def _step_lags(y: Column, p: Column, step: int, lag_mode: str) -> dict[str, Column]:
    """Lag 1/3/7 and the 7-day mean feeding step ``step`` (1-based)."""
    if lag_mode == "history":
        seq = F.concat(y, p)
        lag1 = F.element_at(seq, -1)
        out = {1: lag1}
        for n in (3, 7):
            out[n] = F.when(F.size(seq) >= n, F.element_at(seq, -n)).otherwise(lag1)
        return {**{f"lag{n}": v for n, v in out.items()}, "ma": _mean(_last(seq, S.MA_WINDOW))}
    if step == 1:
        lag1 = F.element_at(y, -1)
        lag3 = F.when(F.size(y) >= 3, F.element_at(y, -3)).otherwise(lag1)
        lag7 = F.when(F.size(y) >= 7, F.element_at(y, -7)).otherwise(lag1)
        return {"lag1": lag1, "lag3": lag3, "lag7": lag7, "ma": _mean(y)}
    k = min(step - 1, S.MA_WINDOW)
    recent = _last(p, k)
    lag1 = F.element_at(recent, -1)
    lag3 = F.element_at(recent, -3) if k >= 3 else lag1
    lag7 = F.element_at(recent, -7) if k >= 7 else lag1
    window = recent if k >= S.MA_WINDOW else F.concat(_last(y, S.MA_WINDOW - k), recent)
    return {"lag1": lag1, "lag3": lag3, "lag7": lag7, "ma": _mean(window)}


STEP_FIELDS = (
    [S.DATE, "year", "month", "dayOfMonth", "dayOfWeek", "isWeekend", "isSummer", "isWinter", "isSpring", "isFall"]
    + list(S.OCCUPANCY_LAGS) + list(S.ADMISSION_LAGS) + list(S.MA_COLUMNS) + [PRED_ADM, PRED_OCC]
)


def forecast_recursive(model: ForecastModel, history: DataFrame, days: int = 30, group_cols=(),
                       lag_mode: str = "reference", checkpoint_every: int = 5,
                       date_col: str = S.DATE) -> DataFrame:
    """M8: forecast ``days`` days after each series' last day, feeding predictions back as lags.

    ``lag_mode='reference'``: day 1 reads the actual history; later days read
    lags from predictions only (lag3 / lag7 fall back to lag1 until three /
    seven predictions exist) and the 7-day mean mixes the last actuals with the
    predictions made so far. ``lag_mode='history'`` reads every lag from
    actuals followed by predictions. Features a step does not produce take
    the fixed defaults. Output: one row per (series, day) with calendar, lags,
    moving averages, both predictions and both alert flags.
    """
    if lag_mode not in ("reference", "history"):
        raise ValueError("lag_mode must be 'reference' or 'history'")
    g = list(group_cols)
    scorers = [tree_scorer(m) for m in (model.admission_model, model.occupancy_model)]
    if all(scorers):
        return model.flagged(forecast_trees(forecast_seed(history, g, date_col), scorers, int(days), g, lag_mode))
    state = forecast_seed(history, g, date_col).withColumns({
        "p_adm": F.array().cast("array<double>"),
        "p_occ": F.array().cast("array<double>"),
        "steps": F.array().cast(f"array<struct<{_step_type()}>>"),
    })
    produced = set(STEP_FIELDS) | set(S.MA_PREV_COLUMNS)
    defaults = {f: F.lit(entry_default(f)) for f in model.feature_names if f not in produced}
    state_cols = [*g, "last_date", "y_adm", "y_occ", "p_adm", "p_occ", "steps"]
    # Both fitted pipelines as one model: one transform (one plan analysis) per step.
    scorer = PipelineModel(stages=list(model.admission_model.stages) + list(model.occupancy_model.stages))
    state = materialize(state, "forecast-seed")
    held: list[DataFrame] = []
    for step in range(1, int(days) + 1):
        a = _step_lags(F.col("y_adm"), F.col("p_adm"), step, lag_mode)
        o = _step_lags(F.col("y_occ"), F.col("p_occ"), step, lag_mode)
        day = F.date_add(F.col("last_date"), step)
        feats = {S.DATE: day, **C.calendar_columns(day)}
        feats.update({
            "occupancyLag1": o["lag1"], "occupancyLag3": o["lag3"], "occupancyLag7": o["lag7"],
            "admissionsLag1": a["lag1"], "admissionsLag3": a["lag3"], "admissionsLag7": a["lag7"],
            "admissionsMA7": a["ma"], "occupancyMA7": o["ma"],
        })
        scored = scorer.transform(state.withColumns(feats).withColumns({
            # The past-only averages are what the model was trained on (same value here).
            "admissionsMA7Prev": F.col("admissionsMA7"), "occupancyMA7Prev": F.col("occupancyMA7"), **defaults,
        }))
        entry = F.struct(*[F.col(f).cast(_field_type(f)).alias(f) for f in STEP_FIELDS])
        state = scored.select(
            *g, "last_date", "y_adm", "y_occ",
            F.concat("p_adm", F.array(F.col(PRED_ADM))).alias("p_adm"),
            F.concat("p_occ", F.array(F.col(PRED_OCC))).alias("p_occ"),
            F.concat("steps", F.array(entry)).alias("steps"),
        ).select(*state_cols)
        # Steps between two written states are cached without a job of their own: the cache keeps
        # the planner from merging them into one ever larger expression.
        if step == days or (checkpoint_every and step % checkpoint_every == 0):
            state = materialize(state, "forecast-state")
            while held:
                held.pop().unpersist()
        else:
            state = state.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(state)
    return model.flagged(state.select(*g, F.inline("steps")))


class TreeScorer:
    """A fitted assembler, scaler and tree ensemble, scored on numpy columns."""

    def __init__(self, features, center, scale, flat, mean: bool):
        self.features, self.center, self.scale, self.flat, self.mean = features, center, scale, flat, mean

    def predict(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        x = np.column_stack([columns[f] for f in self.features])
        if np.isnan(x).any():
            bad = [f for f, c in zip(self.features, x.T) if np.isnan(c).any()]
            raise ValueError(f"missing values in {', '.join(bad)}")
        values = self.flat.values((x - self.center) * self.scale)[0]
        # Summed in the order of the trees.
        total = np.cumsum(values if self.mean else values * self.flat.weights, axis=1)[:, -1]
        return total / values.shape[1] if self.mean else total


def tree_scorer(pipeline: PipelineModel) -> TreeScorer | None:
    """The scorer of a pipeline of ``models.scaled_pipeline``; None for any other."""
    stages = getattr(pipeline, "stages", [])
    kinds = (VectorAssembler, StandardScalerModel, (RandomForestRegressionModel, GBTRegressionModel))
    if len(stages) != 3 or not all(isinstance(s, k) for s, k in zip(stages, kinds)):
        return None
    known = getattr(pipeline, "_tree_scorer", None)
    if known is None:
        assembler, scaler, trees = stages
        std = scaler.std.toArray()
        scale = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0) if scaler.getWithStd() else np.ones_like(std)
        center = scaler.mean.toArray() if scaler.getWithMean() else np.zeros_like(std)
        known = TreeScorer(assembler.getInputCols(), center, scale, flat_trees(trees), isinstance(trees, RandomForestRegressionModel))
        pipeline._tree_scorer = known
    return known


def _right_aligned(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, sizes) of a list column, each list at the right end of its row; nulls are NaN."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    out = np.full((len(sizes), width), np.nan)
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, width - np.repeat(ends, sizes) + np.arange(len(flat))] = flat
    return out, sizes


def _ordered_mean(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean of the last ``sizes`` values of each row, added up from the oldest."""
    total, width = np.zeros(len(values)), values.shape[1]
    for j in range(width):
        total = np.where(width - j <= sizes, total + values[:, j], total)
    return total / sizes


def _lags(actual: np.ndarray, sizes: np.ndarray, made: list[np.ndarray], lag_mode: str) -> dict[str, np.ndarray]:
    """:func:`_step_lags` on arrays: ``actual`` holds each series' last values, ``made`` its predictions so far."""
    week = S.MA_WINDOW
    everything = np.column_stack([actual, *made]) if made else actual
    total = sizes + len(made)
    if lag_mode == "history" or not made:
        have, back = total, everything
        window = np.minimum(total, week) if lag_mode == "history" else sizes
    else:
        have, back = np.full(len(sizes), min(len(made), week)), everything
        window = np.minimum(total, week)
    lag1 = back[:, -1]
    out = {"lag1": lag1}
    for n in (3, 7):
        out[f"lag{n}"] = np.where(have >= n, back[:, -n], lag1) if back.shape[1] >= n else lag1
    out["ma"] = _ordered_mean(everything[:, -week:], window)
    return out


def _calendar(days: np.ndarray) -> dict[str, np.ndarray]:
    """``columns.calendar_columns`` of numpy days."""
    month = days.astype("datetime64[M]")
    m = month.astype(int) % 12 + 1
    weekday = (days.astype(int) + 3) % 7  # 1970-01-01 was a Thursday
    seasons = {"isSummer": S.SUMMER_MONTHS, "isWinter": S.WINTER_MONTHS, "isSpring": S.SPRING_MONTHS, "isFall": S.FALL_MONTHS}
    return {
        "year": days.astype("datetime64[Y]").astype(int) + 1970, "month": m, "dayOfMonth": (days - month).astype(int) + 1,
        "dayOfWeek": weekday, "isWeekend": (weekday >= 5).astype(int),
        **{k: np.isin(m, v).astype(int) for k, v in seasons.items()},
    }


def forecast_trees(seed: DataFrame, scorers: list[TreeScorer], days: int, group_cols=(), lag_mode: str = "reference") -> DataFrame:
    """The rows of :func:`forecast_recursive` without flags, for tree ensembles: one pass over :func:`forecast_seed` rows.

    A batch of series is stepped through the horizon together, a chunk of rows at a time.
    """
    g = list(group_cols)
    types = {"date": T.DateType(), "int": T.IntegerType(), "double": T.DoubleType()}
    arrow = {"date": pa.date32(), "int": pa.int32(), "double": pa.float64()}
    schema = T.StructType([seed.schema[c] for c in g] + [T.StructField(f, types[_field_type(f)]) for f in STEP_FIELDS])
    adm, occ = scorers
    chunk = 2048

    def stepped(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        last = batch.column("last_date").to_numpy(zero_copy_only=False).astype("datetime64[D]")
        if np.isnat(last).any():
            raise ValueError("a series without a date has no next day")
        a, a_size = _right_aligned(batch.column("y_adm"), S.MA_WINDOW)
        o, o_size = _right_aligned(batch.column("y_occ"), S.MA_WINDOW)
        p_adm, p_occ, steps = [], [], []
        for step in range(1, days + 1):
            now = last + step
            la, lo = _lags(a, a_size, p_adm, lag_mode), _lags(o, o_size, p_occ, lag_mode)
            row = {S.DATE: now, **_calendar(now)}
            for name, made in (("admissions", la), ("occupancy", lo)):
                row |= {f"{name}Lag{k}": made[f"lag{k}"] for k in (1, 3, 7)}
                row[f"{name}MA7"] = row[f"{name}MA7Prev"] = made["ma"]
            for f in {*adm.features, *occ.features} - row.keys():
                row[f] = np.full(n, entry_default(f))
            row[PRED_ADM], row[PRED_OCC] = adm.predict(row), occ.predict(row)
            p_adm.append(row[PRED_ADM])
            p_occ.append(row[PRED_OCC])
            steps.append(row)
        # Row by row: series by series, its days in order.
        of = np.repeat(np.arange(n), days)
        keys = [batch.column(c).take(pa.array(of)) for c in g]
        values = [pa.array(np.stack([s[f] for s in steps], axis=1).ravel(), arrow[_field_type(f)]) for f in STEP_FIELDS]
        return pa.RecordBatch.from_arrays(keys + values, [*g, *STEP_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                yield stepped(batch.slice(at, chunk))

    return seed.mapInArrow(run, schema)


def _field_type(name: str) -> str:
    if name == S.DATE:
        return "date"
    if name in ("year", "month", "dayOfMonth", "dayOfWeek", "isWeekend", "isSummer", "isWinter", "isSpring", "isFall"):
        return "int"
    return "double"


def _step_type() -> str:
    return ", ".join(f"{f}: {_field_type(f)}" for f in STEP_FIELDS)


def history_with_forecast(model: ForecastModel, history: DataFrame, forecast: DataFrame, n: int = 50,
                          group_cols=(), date_col: str = S.DATE) -> DataFrame:
    """Last ``n`` history days + the forecast days, all scored by both models,
    with actual values where known and a ``future`` flag (chart data)."""
    tail = tail_by_date(history, n, group_cols, date_col).withColumn("future", F.lit(False))
    fut = forecast.drop(PRED_ADM, PRED_OCC, "admission_alert", "occupancy_alert").withColumn("future", F.lit(True))
    fut = fut.withColumns({"admissionsMA7Prev": F.col("admissionsMA7"), "occupancyMA7Prev": F.col("occupancyMA7")})
    both = tail.unionByName(fut, allowMissingColumns=True)
    # A future day takes the defaults for what it lacks; a null in the real history stays an error.
    lacking = [f for f in model.feature_names if f not in fut.columns]
    filled = both.withColumns({
        f: F.when(F.col("future"), F.lit(entry_default(f))).otherwise(F.col(f).cast("double") if f in both.columns else F.lit(entry_default(f)))
        for f in lacking})
    scored = predict(model, filled)
    keep = [*group_cols, date_col, "future", S.ADMISSIONS, S.OCCUPANCY, PRED_ADM, PRED_OCC,
            "admission_alert", "occupancy_alert"]
    return scored.select(*[c for c in keep if c in scored.columns])
