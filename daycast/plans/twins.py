"""Registered queries on fitted trees small enough for SQL to follow, and on jobs around fitted models.

One boosting round and one forest tree without bootstrap, two levels deep, over
features with fewer distinct values than bins: their cuts, leaf values, gains,
predictions, fold errors and grid scores can be computed by running sums.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast import schema as S
from daycast.operators import daily as D
from daycast.plans import catalog as C
from daycast.plans import jobs as J
from daycast.plans import models as MD
from daycast.plans import trees as TR
from daycast.plans import tuning as TU
from daycast.session import materialize, scratch_path
from daycast.sources import readers as R
from daycast.sources import tables as T

FEATURES = ["month", "dayOfMonth", "dayOfWeek", "year"]
ADMISSIONS = {"maxIter": 1, "maxDepth": 2}
OCCUPANCY = {"numTrees": 1, "maxDepth": 2, "bootstrap": False}


def small_model(spark, sf_dir) -> tuple[DataFrame, MD.ForecastModel]:
    daily = materialize(C.orders_features(spark, sf_dir), "features")
    return daily, MD.ForecastModel(MD.fit_admissions(daily, FEATURES, **ADMISSIONS), MD.fit_occupancy(daily, FEATURES, **OCCUPANCY), FEATURES, 20.0, 49.0)


def q_tree_nodes(spark, sf_dir):
    """M2, M3: every node of both fitted trees: path, feature, cut, rows and value."""
    _, model = small_model(spark, sf_dir)
    parts = [TR.node_rows(m, FEATURES).select(F.lit(name).alias("target"), "node", "feature", "cut", "rows", "value")
             for name, m in (("admissions", model.admission_model), ("occupancy", model.occupancy_model))]
    return C.rounded(parts[0].union(parts[1]))


def q_predict_trees(spark, sf_dir):
    """M6 with both trees."""
    daily, model = small_model(spark, sf_dir)
    return C.rounded(MD.predict(model, daily).select(S.DATE, MD.PRED_ADM, MD.PRED_OCC, "admission_alert", "occupancy_alert"))


def q_importances_trees(spark, sf_dir):
    """Normalised gains, ranked."""
    _, model = small_model(spark, sf_dir)
    return C.rounded(MD.top_importances(MD.feature_importances(model, spark), 10))


def q_cross_validate_trees(spark, sf_dir):
    """Both trees over five expanding folds, the metrics' means."""
    daily = materialize(C.orders_features(spark, sf_dir), "features")
    return C.rounded(TU.cross_validate(daily, FEATURES, 5, ADMISSIONS, OCCUPANCY)[1])


def _scores(results: DataFrame, least) -> DataFrame:
    get = lambda k: F.get_json_object("params", f"$.{k}").cast("int")
    return C.rounded(results.select("target", get("maxDepth").alias("depth"), least(get).alias("least"), "fold", "mse"))


def q_grid_search_trees(spark, sf_dir):
    """M9: both depths of a boosting round, and depths and least split sizes of a tree, over five folds."""
    daily = materialize(C.orders_features(spark, sf_dir), "features")
    _, adm = TU.grid_search(daily, FEATURES, "admissions", {"maxIter": [1], "maxDepth": [1, 2]}, 5)
    _, occ = TU.grid_search(daily, FEATURES, "occupancy", {"numTrees": [1], "maxDepth": [1, 2], "min_samples_split": [2, 700], "bootstrap": [False]}, 5)
    return _scores(adm, lambda get: F.lit(2)).union(_scores(occ, lambda get: get("min_samples_split")))


def q_model_round_trip(spark, sf_dir):
    """Of an older, a newer and a half-written model the newer one is loaded and predicts."""
    folder = scratch_path(spark, f"models-{uuid.uuid4().hex}")
    MD.save_model(C.linear_model(0.0, 0.0), spark, folder)
    MD.save_model(C.linear_model(), spark, folder)
    C.linear_model().admission_model.write().save(MD._paths(folder, "model_99991231_000000")["admission_model"])
    out = MD.predict(MD.load_latest_model(spark, folder), C.orders_features(spark, sf_dir))
    return C.rounded(out.select(S.DATE, MD.PRED_ADM, MD.PRED_OCC, "admission_alert", "occupancy_alert"))


def q_predict_entries(spark, sf_dir):
    """Entries with two of the features; the others take their defaults."""
    entries = C.events_features(spark, sf_dir).select(*C.EVENT_SERIES, S.DATE, "admissionsLag1", "occupancyLag7")
    out = J.predict_entries(C.linear_model(), entries)["predictions"]
    return C.rounded(out.select(*C.EVENT_SERIES, S.DATE, MD.PRED_ADM, MD.PRED_OCC, "admission_alert", "occupancy_alert"))


def q_read_visits(spark, sf_dir):
    """E2 from a CSV of visits whose headers are not the usual ones."""
    folder = scratch_path(spark, f"visits-{uuid.uuid4().hex}")
    e = T.load(spark, sf_dir, "events")
    R.write_table(e.select("event_type", F.col("event_id").alias("key"), F.date_format("ts", "dd/MM/yyyy HH:mm").alias("entered"), F.concat(F.col("value").cast("string"), F.lit("%")).alias("load")), folder, "visits", "csv")
    names = {"patient": "key", "arrival": "entered", "occupancy": "load"}
    return C.rounded(D.build_daily_features(J.read_visits(spark, f"{folder}/visits.csv", names=names), C.EVENT_SERIES, names))


def q_prepare_model_input(spark, sf_dir):
    """Numbers as text, missing numbers and missing text, filled per series."""
    f = C.events_features(spark, sf_dir)
    day = F.col("dayOfMonth")
    return C.rounded(J.prepare_model_input(f.select(
        *C.EVENT_SERIES, F.date_format(S.DATE, "yyyy-MM-dd").alias(S.DATE), F.col("month").cast("string").alias("month"),
        F.when(day % 5 != 0, F.col(S.ADMISSIONS).cast("string")).alias(S.ADMISSIONS), F.when(day % 4 != 0, F.col(S.OCCUPANCY)).alias(S.OCCUPANCY),
        F.when(day % 3 != 0, F.concat(F.lit("team "), (day % 4).cast("string"))).alias("team"),
        F.when(day % 7 != 0, F.concat(F.lit("shift "), (day % 2).cast("string"))).alias("shift")), group_cols=C.EVENT_SERIES))


QUERIES = {
    "tree_nodes": q_tree_nodes,
    "predict_trees": q_predict_trees,
    "importances_trees": q_importances_trees,
    "cross_validate_trees": q_cross_validate_trees,
    "grid_search_trees": q_grid_search_trees,
    "model_round_trip": q_model_round_trip,
    "predict_entries": q_predict_entries,
    "read_visits": q_read_visits,
    "prepare_model_input": q_prepare_model_input,
}
