"""Regressors, the fitted model bundle and its persistence.

Both targets use ``VectorAssembler -> StandardScaler(mean, std) -> trees``:
gradient-boosted trees for daily admissions, a random forest for mean bed
occupancy. Spark ML distributes the fitting over the rows; scoring is a
per-row JVM transform (no shuffle).
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast import schema as S
from daycast.operators import alerts as AL
from daycast.operators import metrics as M
from daycast.operators.keys import join_series
from daycast.plans.trees import truncated

# maxBins: candidate split points per feature; raise it for finer splits (time and memory grow with it).
ADMISSION_PARAMS = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 4, "maxBins": 64, "seed": 42}
OCCUPANCY_PARAMS = {"numTrees": 100, "maxDepth": None, "min_samples_split": 2, "maxBins": 64, "seed": 42}
# Spark's deepest tree: what maxDepth=None ("unlimited") means. A larger explicit depth is an error.
MAX_TREE_DEPTH = 30

PRED_ADM = "predicted_admissions"
PRED_OCC = "predicted_occupancy"
THRESHOLD = "_admission_threshold"


def scaled_pipeline(features, regressor, prefix: str) -> Pipeline:
    """M1: assemble ``features`` (nulls are an error), standardise, regress."""
    vec, scaled = f"_{prefix}_vec", f"_{prefix}_scaled"
    regressor.setFeaturesCol(scaled)
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol=vec, handleInvalid="error"),
        StandardScaler(inputCol=vec, outputCol=scaled, withMean=True, withStd=True),
        regressor,
    ])


def _depth(depth) -> int:
    if depth is None:
        return MAX_TREE_DEPTH
    if int(depth) > MAX_TREE_DEPTH:
        raise ValueError(f"maxDepth {depth}: Spark's trees have at most {MAX_TREE_DEPTH} levels")
    return int(depth)


def fit_rows(df: DataFrame, limit: int | None = None) -> DataFrame:
    """All rows; only for a caller that sets ``limit``, beyond it a share picked by a hash of the row's values."""
    n = df.count() if limit else 0
    if not limit or n <= limit:
        return df
    cells = 1 << 30
    return df.where(F.pmod(F.xxhash64(*df.columns), F.lit(cells)) < F.lit(int(cells * (limit / n))))


def admissions_regressor(label: str = S.ADMISSIONS, prediction: str = PRED_ADM, **params) -> GBTRegressor:
    """M2's estimator: boosted trees (100 rounds, rate 0.1, depth 4, seed 42 by default)."""
    p = {**ADMISSION_PARAMS, **params}
    return GBTRegressor(labelCol=label, predictionCol=prediction, maxIter=int(p["maxIter"]),
                        stepSize=float(p["stepSize"]), maxDepth=_depth(p["maxDepth"]), maxBins=int(p["maxBins"]),
                        seed=int(p["seed"]))


def occupancy_regressor(label: str = S.OCCUPANCY, prediction: str = PRED_OCC, **params) -> RandomForestRegressor:
    """M3's estimator: a forest using every feature at each split, grown to leaves of one row.

    ``maxDepth=None`` means the deepest tree Spark allows; ``bootstrap=False``
    gives every tree all rows. A minimum split size is applied to the grown trees (see :func:`fit_occupancy`).
    """
    p = {**OCCUPANCY_PARAMS, **params}
    # cacheNodeIds / maxMemoryInMB only change how deep trees are grown
    # (fewer passes over the data), not the fitted trees.
    return RandomForestRegressor(labelCol=label, predictionCol=prediction, numTrees=int(p["numTrees"]),
                                 maxDepth=_depth(p["maxDepth"]), maxBins=int(p["maxBins"]), featureSubsetStrategy="all",
                                 bootstrap=bool(p.get("bootstrap", True)), seed=int(p["seed"]), cacheNodeIds=True, maxMemoryInMB=1024)


def fit_admissions(df: DataFrame, features, label: str = S.ADMISSIONS, **params) -> PipelineModel:
    """M2, on all rows unless the caller gives ``max_fit_rows`` (see :func:`fit_rows`)."""
    limit = params.pop("max_fit_rows", None)
    return scaled_pipeline(features, admissions_regressor(label, **params), "adm").fit(fit_rows(df, limit))


def fit_occupancy(df: DataFrame, features, label: str = S.OCCUPANCY, **params) -> PipelineModel:
    """M3, on all rows unless the caller gives ``max_fit_rows``.

    ``min_samples_split``: no node of fewer rows is split. With every feature
    tried at each split it only ends growth, so the grown trees are cut there.
    Rows are counted as a tree draws them: one drawn twice counts twice.
    """
    limit = params.pop("max_fit_rows", None)
    least = int(params.get("min_samples_split", OCCUPANCY_PARAMS["min_samples_split"]))
    fitted = scaled_pipeline(features, occupancy_regressor(label, **params), "occ").fit(fit_rows(df, limit))
    if least <= 2:  # a node of one row has nothing to split
        return fitted
    return PipelineModel(stages=[*fitted.stages[:-1], truncated(fitted.stages[-1], least=least)])


@dataclass
class ForecastModel:
    """Both fitted pipelines plus what forecasting and alerting need.

    A model of many series has a table of admission thresholds: ``series_cols``
    and ``threshold``; ``admission_threshold`` holds for series not in it (None: no alert).
    """

    admission_model: PipelineModel
    occupancy_model: PipelineModel
    feature_names: list[str]
    admission_threshold: float | None
    occupancy_threshold: float = S.OCCUPANCY_THRESHOLD
    series_thresholds: DataFrame | None = None
    series_cols: tuple[str, ...] = ()
    metrics: dict = field(default_factory=dict)
    timestamp: str = field(default_factory=lambda: _dt.datetime.now().isoformat())
    model_version: str = "1.0"

    def importances(self) -> dict[str, dict[str, float]]:
        out = {}
        for name, pm in (("admissions", self.admission_model), ("occupancy", self.occupancy_model)):
            imp = getattr(pm.stages[-1], "featureImportances", None)  # only trees have them
            out[name] = {} if imp is None else dict(zip(self.feature_names, map(float, imp.toArray())))
        return out

    def alert_rules(self) -> list[AL.AlertRule]:
        """Rules for rows of :meth:`with_thresholds`."""
        return AL.default_rules(THRESHOLD if self.series_thresholds is not None else self.admission_threshold, self.occupancy_threshold)

    def with_thresholds(self, df: DataFrame) -> DataFrame:
        """``df`` with its series' admission threshold, where the model has one per series."""
        if self.series_thresholds is None:
            return df
        table = self.series_thresholds.select(*self.series_cols, F.col("threshold").alias(THRESHOLD))
        joined = join_series(df.drop(THRESHOLD), table, self.series_cols)
        return joined.withColumn(THRESHOLD, F.coalesce(F.col(THRESHOLD), F.lit(self.admission_threshold).cast("double")))

    def flagged(self, df: DataFrame) -> DataFrame:
        """P16 with this model's thresholds."""
        return AL.flag_alerts(self.with_thresholds(df), self.alert_rules()).drop(THRESHOLD)

    def alerts(self, df: DataFrame, group_cols=()) -> DataFrame:
        """P17 with this model's thresholds."""
        return AL.alert_rows(self.with_thresholds(df), self.alert_rules(), group_cols=group_cols)


def feature_importances(model: ForecastModel, spark: SparkSession) -> DataFrame:
    """M4: ``(model, feature, importance)`` for both models (one row per feature)."""
    rows = [(m, f, v) for m, imp in model.importances().items() for f, v in imp.items()]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def top_importances(importances: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most important features of each model, descending."""
    w = Window.partitionBy("model").orderBy(F.desc("importance"), F.asc("feature"))
    return importances.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def _drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_adm_") or c.startswith("_occ_")])


def predict(model: ForecastModel | None, df: DataFrame) -> DataFrame:
    """M6: both predictions and their alert flags."""
    if model is None or model.admission_model is None or model.occupancy_model is None:
        raise ValueError("the models must be fitted before predicting")
    out = model.occupancy_model.transform(model.admission_model.transform(df))
    return model.flagged(_drop_internal(out))


def prediction_pairs(adm: str = S.ADMISSIONS, occ: str = S.OCCUPANCY) -> dict:
    return {"admissions": (adm, PRED_ADM), "occupancy": (occ, PRED_OCC)}


def evaluate_model(model: ForecastModel, df: DataFrame, group_cols=(), extended: bool = False) -> DataFrame:
    """Predict, then mse / rmse / mae / r2 (plus mape and explained variance)."""
    return M.regression_metrics(predict(model, df), prediction_pairs(), group_cols, extended)


def metrics_dict(metrics: DataFrame) -> dict:
    """Long metric rows (bounded: targets x metrics) to ``{target: {metric: value}}``."""
    out: dict = {}
    for r in metrics.collect():
        out.setdefault(r["target"], {})[r["metric"]] = r["value"]
    return out


# -- persistence -------------------------------------------------------------------

META_SCHEMA = T.StructType([
    T.StructField("prefix", T.StringType()),
    T.StructField("feature_names", T.ArrayType(T.StringType())),
    T.StructField("feature_importance_admission", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("feature_importance_occupancy", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("admission_threshold", T.DoubleType()),
    T.StructField("occupancy_threshold", T.DoubleType()),
    T.StructField("metrics", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("series_cols", T.ArrayType(T.StringType())),
    T.StructField("thresholds", T.StringType()),
])


def _paths(directory: str, prefix: str) -> dict[str, str]:
    base = directory.rstrip("/") + "/" + prefix
    return {
        "admission_model": base + "_admission_model",
        "occupancy_model": base + "_occupancy_model",
        "metadata": base + "_metadata",
        "thresholds": base + "_thresholds",
    }


def save_model(model: ForecastModel, spark: SparkSession, directory: str, prefix: str | None = None) -> dict[str, str]:
    """Both pipelines (Spark ML format), the series' thresholds, and last a one-row JSON record.

    The record commits the model: readers begin with it, so a model whose
    writing was cut short is never found. It names the thresholds' table.
    """
    prefix = prefix or "model_" + _dt.datetime.now().strftime("%Y%m%d_%H%M%S_%f")
    paths = _paths(directory, prefix)
    model.admission_model.write().overwrite().save(paths["admission_model"])
    model.occupancy_model.write().overwrite().save(paths["occupancy_model"])
    if model.series_thresholds is not None:
        model.series_thresholds.write.mode("overwrite").parquet(paths["thresholds"])
    else:
        paths.pop("thresholds")
    imp = model.importances()
    row = (prefix, list(model.feature_names), imp["admissions"], imp["occupancy"],
           model.admission_threshold, float(model.occupancy_threshold),
           json.dumps(model.metrics), model.timestamp, model.model_version, list(model.series_cols), paths.get("thresholds", "").rpartition("/")[2] or None)
    spark.createDataFrame([row], META_SCHEMA).coalesce(1).write.mode("overwrite").json(paths["metadata"])
    return paths


def load_model(spark: SparkSession, admission_path: str, occupancy_path: str,
               metadata_path: str | None = None, admission_threshold: float | None = None) -> ForecastModel:
    """Load both pipelines and their metadata; without metadata a threshold is required."""
    if metadata_path is None and admission_threshold is None:
        raise ValueError("a model without metadata needs an admission_threshold")
    adm = PipelineModel.load(admission_path)
    occ = PipelineModel.load(occupancy_path)
    if metadata_path is None:
        return ForecastModel(adm, occ, list(adm.stages[0].getInputCols()), float(admission_threshold))
    r = spark.read.schema(META_SCHEMA).json(metadata_path).first()
    series = tuple(r["series_cols"] or ())
    folder, _, name = metadata_path.rstrip("/").rpartition("/")
    table = spark.read.parquet(f"{folder}/{r['thresholds'] or name.removesuffix('_metadata') + '_thresholds'}") if series else None
    return ForecastModel(adm, occ, list(r["feature_names"]), r["admission_threshold"], r["occupancy_threshold"],
                         table, series, json.loads(r["metrics"] or "{}"), r["timestamp"], r["model_version"])


def load_latest_model(spark: SparkSession, location: str) -> ForecastModel:
    """An exact ``*_admission_model`` path, or the newest committed model in a directory.

    A directory without one is a FileNotFoundError; any other failure to read is raised as it is.
    """
    loc = location.rstrip("/")
    if loc.endswith("_admission_model"):
        base = loc[: -len("_admission_model")]
        return load_model(spark, loc, base + "_occupancy_model", base + "_metadata")
    try:
        meta = spark.read.schema(META_SCHEMA).json(loc + "/*_metadata")
        row = meta.where(F.col("prefix").isNotNull()).orderBy(F.desc("timestamp"), F.desc("prefix")).select("prefix").limit(1).collect()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no model found in {location!r}") from exc
    if not row:
        raise FileNotFoundError(f"no model found in {location!r}")
    p = _paths(loc, row[0]["prefix"])
    return load_model(spark, p["admission_model"], p["occupancy_model"], p["metadata"])
