import json

from daycast.plans import catalog
from daycast.plans import jobs as J
from daycast.plans import tuning as TU


def test_grid_search_and_optimized_training(spark):
    daily = J.prepare_model_input(catalog.orders_features(spark, "/root/testdata/sf0.001")).persist()
    feats = J.default_features(daily)
    grid = {"maxIter": [2, 4], "maxDepth": [2]}
    best, results = TU.grid_search(daily, feats, "admissions", grid, n_splits=2, parallelism=2)
    rows = results.collect()
    assert len(rows) == 2 * 2  # candidates x folds
    means = {}
    for r in rows:
        means.setdefault(r.params, []).append(r.mse)
    expected = min(means, key=lambda p: sum(means[p]) / len(means[p]))
    assert json.loads(expected) == best
    res = J.train(daily, optimize=True, n_splits=2, admission_grid=grid,
                  occupancy_grid={"numTrees": [2], "maxDepth": [3], "min_samples_split": [2, 4]})
    gbt = res.model.admission_model.stages[-1]
    assert gbt.getNumTrees == res.best_params["admissions"]["maxIter"]  # the tuned parameters are used
    rf = res.model.occupancy_model.stages[-1]
    assert rf.getNumTrees == 2


def test_cross_validate_folds(spark):
    daily = J.prepare_model_input(catalog.orders_features(spark, "/root/testdata/sf0.001")).persist()
    per_fold, mean = TU.cross_validate(daily, J.default_features(daily), 3, {"maxIter": 2}, {"numTrees": 2})
    assert per_fold.select("fold").distinct().count() == 3
    assert mean.count() == 8  # 2 targets x 4 metrics


def test_first_trees_of_a_forest_score_the_smaller_numbers(spark):
    daily = J.prepare_model_input(catalog.orders_features(spark, "/root/testdata/sf0.001")).persist()
    feats = J.default_features(daily)
    grid = {"numTrees": [2, 5], "maxDepth": [3], "min_samples_split": [2]}
    _, results = TU.grid_search(daily, feats, "occupancy", grid, n_splits=2, parallelism=2)
    assert results.count() == 2 * 2
    model = TU.MD.fit_occupancy(daily, feats, numTrees=5, maxDepth=3, min_samples_split=2)
    forest = model.stages[-1]
    scaled = TU.PipelineModel(stages=model.stages[:-1]).transform(daily.limit(20)).persist()
    rows = [r[forest.getFeaturesCol()] for r in scaled.collect()]
    for n in (2, 5):
        got = [r[TU.MD.PRED_OCC] for r in TU.first_trees(forest, n).transform(scaled).collect()]
        want = [sum(t.predict(x) for t in forest.trees[:n]) / n for x in rows]
        assert max(abs(a - b) for a, b in zip(got, want)) < 1e-9
    assert [forest.predict(x) for x in rows] == [TU.first_trees(forest, 5).predict(x) for x in rows]


def test_grid_search_queries_run_the_whole_grids(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(TU, "_fold_mse", lambda train, test, features, target, params, sizes: seen.append(target) or [0.0] * len(sizes))
    for name, target in (("grid_search", "admissions"), ("grid_search_occupancy", "occupancy")):
        rows = catalog.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
        assert len({r.params for r in rows}) == 27 and len(rows) == 27 * 5
        assert seen.count(target) == 9 * 5
