"""Expanding-window cross-validation and grid search.

Spark's ``CrossValidator`` trains each fold on all *other* folds, which would
let a model see the future of a time series. Here every fold trains on the
rows before its test block (W8). The labelled table is ranked once and
persisted; a fold's rows are assembled and scaled once for all its candidates.

Candidates that only stop growth earlier share one fit (see ``plans.trees``): a
forest with the most trees, the deepest limit and no least split size answers for
every smaller forest, and the longest boosting run for every shorter one. All boosting
runs of a grid, on all folds, grow together (see ``plans.boosting``): a Spark job a tree
level, whatever the number of candidates. Forests are fitted and all scores made
concurrently from a small thread pool.
"""

from __future__ import annotations

import itertools
import json
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast import schema as S
from daycast.operators import metrics as M
from daycast.operators.splits import fold_frames, time_series_folds
from daycast.plans import boosting as BO
from daycast.plans import models as MD
from daycast.plans import trees as TR

ADMISSION_GRID = {"maxIter": [50, 100, 200], "stepSize": [0.05, 0.1, 0.2], "maxDepth": [3, 4, 5]}
OCCUPANCY_GRID = {"numTrees": [50, 100, 200], "maxDepth": [None, 10, 20], "min_samples_split": [2, 5, 10]}

TARGETS = {
    "admissions": (S.ADMISSIONS, MD.fit_admissions, MD.PRED_ADM, MD.ADMISSION_PARAMS),
    "occupancy": (S.OCCUPANCY, MD.fit_occupancy, MD.PRED_OCC, MD.OCCUPANCY_PARAMS),
}


def param_grid(grid: dict) -> list[dict]:
    keys = list(grid)
    return [dict(zip(keys, values)) for values in itertools.product(*[grid[k] for k in keys])]


#: Parameters of which a larger fit holds the smaller ones: boosting rounds, and trees of a forest.
PREFIX = {"admissions": "maxIter", "occupancy": "numTrees"}

#: Daily rows per partition while tuning: many small fits run side by side, each with few tasks.
PART_ROWS = 20_000


def _labelled(df: DataFrame, n_splits: int, group_cols) -> DataFrame:
    """The fold labels on one cached table with partitions of about PART_ROWS rows."""
    labelled = time_series_folds(df, n_splits, group_cols, common=bool(group_cols))
    parts = -(-df.count() // PART_ROWS)
    return labelled.coalesce(max(1, parts)).persist(StorageLevel.MEMORY_AND_DISK)


class _Fold:
    """One fold's rows, assembled and scaled once, and the ensembles fitted on them."""

    def __init__(self, labelled: DataFrame, number: int, features, target: str, largest: dict | None, runs: _Runs | None = None):
        self.train, self.test = fold_frames(labelled, number)
        self.number, self.runs = number, runs
        self.features, self.label, self.target, self.largest = list(features), TARGETS[target][0], target, largest
        self.lock, self.tables, self.fitted = threading.Lock(), None, {}

    def scaled(self) -> tuple[DataFrame, DataFrame]:
        """Cached (train, test): the scaled vector ``_x``, fitted on the training rows, and the label."""
        if self.tables is None:
            stages = MD.scaled_pipeline(self.features, MD.admissions_regressor(self.label), "fold").getStages()
            scaler = Pipeline(stages=stages[:-1]).fit(self.train)
            self.tables = tuple(scaler.transform(part).select(F.col("_fold_scaled").alias("_x"), F.col(self.label).cast("double").alias(self.label))
                                .persist(StorageLevel.MEMORY_AND_DISK) for part in (self.train, self.test))
        return self.tables

    def trees(self, params: dict) -> TR.FlatTrees:
        """The fitted ensemble of ``params``, fitted by the first to ask: a forest that holds the whole grid, or the boosting runs of all candidates."""
        if self.target == "occupancy":
            grown = {**params, **(self.largest or {}), "min_samples_split": 2}
            key = json.dumps(grown, sort_keys=True)
            with self.lock:
                if key not in self.fitted:
                    model = MD.occupancy_regressor(self.label, **grown).setFeaturesCol("_x").fit(self.scaled()[0])
                    self.fitted[key] = TR.flat_trees(model)
                return self.fitted[key]
        return self.runs.trees(self.number, params)

    def release(self) -> None:
        for part in self.tables or ():
            part.unpersist()


class _Runs:
    """The boosting runs of all candidates on all folds, grown together when the first is asked for."""

    def __init__(self, candidates: list[dict], label: str):
        self.candidates, self.label, self.folds = candidates, label, []
        self.lock, self.fitted = threading.Lock(), None

    def trees(self, number: int, params: dict) -> TR.FlatTrees:
        with self.lock:
            if self.fitted is None:
                self.fitted = self._fit()
        return self.fitted[number, self._key(params)]

    @staticmethod
    def _key(params: dict) -> str:
        return json.dumps({k: v for k, v in params.items() if k != PREFIX["admissions"]}, sort_keys=True)

    def _fit(self) -> dict:
        longest: dict[str, dict] = {}
        for c in self.candidates:
            key, rounds = self._key(c), int(c["maxIter"])
            longest[key] = {**c, "maxIter": max(rounds, longest.get(key, c)["maxIter"]), "maxDepth": MD._depth(c["maxDepth"])}
        train = {f.number: f.scaled()[0] for f in self.folds}
        fitted = {}
        for bins, seed in dict.fromkeys((int(m["maxBins"]), int(m["seed"])) for m in longest.values()):
            some = {key: m for key, m in longest.items() if (int(m["maxBins"]), int(m["seed"])) == (bins, seed)}
            grown = BO.boosted(train, "_x", self.label, list(some.values()), bins, seed)
            fitted |= {(number, list(some)[i]): flat for (number, i), flat in grown.items()}
        return fitted


def _fold_mse(fold: _Fold, test: DataFrame, features, target: str, params: dict, sizes) -> list[float]:
    """Test MSE of one candidate, or of its first rounds or trees for every number in ``sizes``.

    Round k only adds to the rounds before it. A forest's trees do not depend on
    each other, and its depth and least split size are cuts of the fold's one
    grown forest. One pass over the test rows scores every number.
    """
    prefix = PREFIX[target]
    wanted = [int(n) for n in sizes] if sizes else [int(params[prefix])]
    flat = fold.trees({**params, prefix: max(wanted)})
    limit = (params["maxDepth"], int(params["min_samples_split"])) if target == "occupancy" else (None, 0)
    scores = TR.squared_errors(fold.scaled()[1], "_x", fold.label, flat, [limit], wanted, mean=target == "occupancy")
    if not scores:
        raise ValueError(f"fold without a row that has {fold.label} and a prediction")
    return [scores[0, n][1] / scores[0, n][0] for n in wanted]


def first_trees(forest: RandomForestRegressionModel, n: int) -> RandomForestRegressionModel:
    """The forest of the first ``n`` trees."""
    sc = SparkContext._active_spark_context
    trees, classes = forest._java_obj.trees(), sc._jvm.org.apache.spark.ml.regression
    first = sc._gateway.new_array(classes.DecisionTreeRegressionModel, n)
    for i in range(n):
        first[i] = trees[i]
    made = classes.RandomForestRegressionModel(f"{forest.uid}_{n}", first, forest.numFeatures)
    made.set(made.getParam("numTrees"), n)  # the divisor of the mean
    small = RandomForestRegressionModel(made)
    return small.setFeaturesCol(forest.getFeaturesCol()).setPredictionCol(forest.getPredictionCol())


def _largest_forest(candidates: list[dict]) -> dict:
    """Parameters of the forest that holds all ``candidates``."""
    depths = [c["maxDepth"] for c in candidates]
    return {"numTrees": max(int(c["numTrees"]) for c in candidates), "maxDepth": None if None in depths else max(depths)}


def grid_search(df: DataFrame, features, target: str = "admissions", grid: dict | None = None,
                n_splits: int = 5, parallelism: int = 8, group_cols=()):
    """M9: the parameters with the lowest mean test MSE over the expanding folds.

    Returns ``(best_params, results)`` where ``results`` has one row per
    (candidate, fold) with its MSE. Ties go to the earlier candidate.
    """
    if target not in TARGETS:
        raise ValueError(f"target must be one of {sorted(TARGETS)}")
    grid = grid or (ADMISSION_GRID if target == "admissions" else OCCUPANCY_GRID)
    base = TARGETS[target][3]
    candidates = [{**base, **c} for c in param_grid(grid)]
    prefix = PREFIX[target] if PREFIX[target] in grid else None
    # Candidates that differ in the prefix parameter only are scored together.
    groups: dict[str, list[int]] = {}
    for ci, c in enumerate(candidates):
        groups.setdefault(json.dumps({k: v for k, v in c.items() if k != prefix}, sort_keys=True), []).append(ci)
    labelled = _labelled(df, n_splits, group_cols)
    runs = _Runs(candidates, TARGETS[target][0]) if target == "admissions" else None
    folds = [_Fold(labelled, i, features, target, _largest_forest(candidates) if target == "occupancy" else None, runs) for i in range(n_splits)]
    if runs:
        runs.folds = folds
    try:
        def cost(task):  # deeper trees take more passes, later folds have more rows
            members, fi = task
            depth = MD._depth(candidates[members[0]]["maxDepth"])
            return (fi + 1) * (depth + 1) if target == "admissions" else fi - n_splits * members[0]

        tasks = sorted(((members, fi) for members in groups.values() for fi in range(n_splits)), key=cost, reverse=True)

        def run(task):
            members, fi = task
            sizes = [candidates[ci][prefix] for ci in members] if prefix else None
            errors = _fold_mse(folds[fi], folds[fi].test, features, target, candidates[members[0]], sizes)
            return [(ci, fi, mse) for ci, mse in zip(members, errors)]

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            scores = sorted(x for chunk in pool.map(run, tasks) for x in chunk)
    finally:
        for fold in folds:
            fold.release()
        labelled.unpersist()
    means = {}
    for ci, _, mse in scores:
        means.setdefault(ci, []).append(mse)
    best = min(means, key=lambda ci: (sum(means[ci]) / len(means[ci]), ci))
    spark = df.sparkSession
    results = spark.createDataFrame(
        [(target, json.dumps(candidates[ci], sort_keys=True), fi, mse) for ci, fi, mse in scores],
        "target string, params string, fold int, mse double",
    )
    return candidates[best], results


def cross_validate(df: DataFrame, features, n_splits: int = 5, admission_params: dict | None = None,
                   occupancy_params: dict | None = None, group_cols=(), parallelism: int = 8):
    """Per fold, fit both models on the earlier rows and score the fold (A9),
    then average per metric (A13). Returns ``(per_fold, mean)`` DataFrames."""
    labelled = _labelled(df, n_splits, group_cols)
    params = {"admissions": admission_params or {}, "occupancy": occupancy_params or {}}
    try:
        def run(task):
            fi, target = task
            label, fit, pred, _ = TARGETS[target]
            train, test = fold_frames(labelled, fi)
            model = fit(train, features, label, **params[target])
            m = M.regression_metrics(model.transform(test), {target: (label, pred)})
            return [(fi, r["target"], r["metric"], r["value"]) for r in m.collect()]

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            rows = [r for chunk in pool.map(run, [(fi, t) for fi in range(n_splits) for t in TARGETS]) for r in chunk]
    finally:
        labelled.unpersist()
    per_fold = df.sparkSession.createDataFrame(rows, "fold int, target string, metric string, value double")
    return per_fold, M.fold_metrics_mean(per_fold)
