"""Flat node arrays against Spark's own ensembles: walks, truncation, prefixes, one-pass forecasts."""

import datetime as dt

import numpy as np
import pytest
from daycast.plans import forecast as FC
from daycast.plans import models as MD
from daycast.plans import trees as TR
from daycast.plans import tuning as TU

FEATURES = ["dayOfWeek", "admissionsLag1", "occupancyLag7", "admissionsMA7Prev", "waitingHours"]


@pytest.fixture(scope="module")
def daily(spark):
    r = np.random.default_rng(7)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), float(r.integers(5, 40)), float(r.normal(70, 9)), float(i % 7), float(r.integers(5, 40)),
             float(r.normal(70, 9)), float(r.integers(5, 40)), 80.0) for i in range(240)]
    return spark.createDataFrame(rows, "date date, totalAdmissions double, avgOccupancyRate double, dayOfWeek double, admissionsLag1 double, "
                                 "occupancyLag7 double, admissionsMA7Prev double, waitingHours double").coalesce(1).persist()


@pytest.fixture(scope="module")
def forest(daily):
    return MD.fit_occupancy(daily, FEATURES, numTrees=6)


@pytest.fixture(scope="module")
def boosted(daily):
    return MD.fit_admissions(daily, FEATURES, maxIter=12, maxDepth=3)


def vectors(pipeline, daily):
    rows = pipeline.transform(daily).collect()
    name = pipeline.stages[-1].getFeaturesCol()
    return [r[name] for r in rows], np.array([r[name].toArray() for r in rows])


def test_walk_equals_the_models(daily, forest, boosted):
    for pipeline, mean in ((forest, True), (boosted, False)):
        model = pipeline.stages[-1]
        flat = TR.flat_trees(model)
        vs, x = vectors(pipeline, daily)
        got = flat.values(x)[0]
        total = got.mean(axis=1) if mean else got @ flat.weights
        assert np.allclose(total, [model.predict(v) for v in vs], atol=1e-9)
        assert flat.first(3).values(x)[0].shape == (240, 3) and np.array_equal(flat.first(3).values(x)[0], got[:, :3])


@pytest.mark.parametrize("depth", [0, 1, 4, 9])
def test_a_cut_depth_is_a_direct_fit(daily, forest, depth):
    direct = MD.fit_occupancy(daily, FEATURES, numTrees=6, maxDepth=depth).stages[-1]
    cut = TR.truncated(forest.stages[-1], deepest=depth)
    vs, x = vectors(forest, daily)
    assert [cut.predict(v) for v in vs] == [direct.predict(v) for v in vs]
    assert cut.totalNumNodes == direct.totalNumNodes
    walked = TR.flat_trees(forest.stages[-1]).values(x, [(depth, 0)])[0].mean(axis=1)
    assert np.allclose(walked, [direct.predict(v) for v in vs], atol=1e-9)


def test_no_node_below_the_least_size_is_split(daily, forest):
    whole = TR.flat_trees(forest.stages[-1])
    assert whole.rows[whole.left >= 0].min() < 10
    fitted = MD.fit_occupancy(daily, FEATURES, numTrees=6, min_samples_split=10)
    model = fitted.stages[-1]
    flat = TR.flat_trees(model)
    inner = flat.left >= 0
    assert inner.any() and flat.rows[inner].min() >= 10
    # Nothing more is cut: every node that is a leaf now was one, or has fewer than ten rows.
    kept, cut = whole.kept(None, 10)
    assert np.array_equal(whole.rows[kept], flat.rows) and (whole.rows[cut & (whole.left >= 0)] < 10).all()
    vs, x = vectors(fitted, daily)
    assert np.allclose(whole.values(x, [(None, 10)])[0].mean(axis=1), [model.predict(v) for v in vs], atol=1e-9)
    assert abs(sum(model.featureImportances.toArray()) - 1) < 1e-9


def test_staged_errors_equal_direct_fits(daily, boosted):
    flat = TR.flat_trees(boosted.stages[-1])
    scaled = boosted.transform(daily)
    got = TR.squared_errors(scaled, "_adm_scaled", "totalAdmissions", flat, [(None, 0)], [3, 12], mean=False)
    for n in (3, 12):
        direct = MD.fit_admissions(daily, FEATURES, maxIter=n, maxDepth=3).transform(daily)
        want = direct.selectExpr("sum(power(totalAdmissions - predicted_admissions, 2)) AS s", "count(*) AS n").first()
        assert got[0, n][0] == want.n and got[0, n][1] == pytest.approx(want.s)
    nothing = scaled.where("totalAdmissions IS NULL")
    assert TR.squared_errors(nothing, "_adm_scaled", "totalAdmissions", flat, [(None, 0)], [3], mean=False) == {}


def test_one_forest_a_fold_answers_for_the_grid(daily, monkeypatch):
    fits = []
    plain = MD.occupancy_regressor
    monkeypatch.setattr(MD, "occupancy_regressor", lambda *a, **k: fits.append(k) or plain(*a, **k))
    grid = {"numTrees": [2, 3], "maxDepth": [None, 3], "min_samples_split": [2, 5]}
    best, results = TU.grid_search(daily, FEATURES, "occupancy", grid, n_splits=2, parallelism=3)
    rows = results.collect()
    assert len(rows) == 16 and len(fits) == 2
    assert all(f["numTrees"] == 3 and f["maxDepth"] is None for f in fits)
    import json

    folds = TU.time_series_folds(daily, 2)
    train, test = TU.fold_frames(folds, 1)
    direct = MD.fit_occupancy(train.coalesce(1), FEATURES, numTrees=3, maxDepth=3, min_samples_split=5).transform(test)
    want = direct.selectExpr("avg(power(avgOccupancyRate - predicted_occupancy, 2)) AS s").first().s
    got = [r.mse for r in rows if r.fold == 1 and json.loads(r.params)["numTrees"] == 3 and json.loads(r.params)["maxDepth"] == 3 and json.loads(r.params)["min_samples_split"] == 5]
    assert got == [pytest.approx(want)]
    assert best in [json.loads(r.params) for r in rows]


@pytest.mark.parametrize("lag_mode", ["reference", "history"])
def test_one_pass_forecast_equals_the_loop(spark, daily, forest, boosted, lag_mode, monkeypatch):
    model = MD.ForecastModel(boosted, forest, FEATURES, 20.0, 71.0)
    day = dt.date(2024, 2, 20)
    rows = [(s, day + dt.timedelta(days=i), float(9 + (i * 7 + k) % 21), 66.0 + (i * 3 + k) % 11) for k, (s, n) in enumerate((("a", 2), (None, 5), ("c", 12))) for i in range(n)]
    history = spark.createDataFrame(rows, "s string, date date, totalAdmissions double, avgOccupancyRate double")
    got = FC.forecast_recursive(model, history, 12, ["s"], lag_mode)
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    one = sorted(got.collect(), key=str)
    monkeypatch.setattr(FC, "tree_scorer", lambda m: None)
    loop = FC.forecast_recursive(model, history, 12, ["s"], lag_mode)
    assert [(f.name, f.dataType) for f in loop.schema] == [(f.name, f.dataType) for f in got.schema]
    for a, b in zip(one, sorted(loop.collect(), key=str), strict=True):
        assert tuple(a) == pytest.approx(tuple(b)) if a.s else a.asDict() == pytest.approx(b.asDict())


def test_missing_history_is_an_error(spark, forest, boosted):
    model = MD.ForecastModel(boosted, forest, FEATURES, 20.0)
    history = spark.createDataFrame([(dt.date(2024, 1, 1), 3.0, None)], "date date, totalAdmissions double, avgOccupancyRate double")
    with pytest.raises(Exception, match="missing values in occupancyLag7"):
        FC.forecast_recursive(model, history, 2).collect()
