import numpy as np
import pytest
from daycast.plans import boosting as BO
from daycast.plans import catalog
from daycast.plans import jobs as J
from daycast.plans import models as MD
from daycast.plans import trees as TR
from daycast.plans import tuning as TU
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector

MODELS = [{"maxIter": 6, "stepSize": 0.1, "maxDepth": 5}, {"maxIter": 3, "stepSize": 0.2, "maxDepth": 2}]


@pytest.fixture(scope="module")
def scaled(spark):
    daily = J.prepare_model_input(catalog.orders_features(spark, "/root/testdata/sf0.001"))
    feats = J.default_features(daily)
    labelled = TU._labelled(daily, 2, ())
    stages = MD.scaled_pipeline(feats, MD.admissions_regressor(), "x").getStages()[:-1]
    return Pipeline(stages=stages).fit(labelled).transform(labelled).withColumnRenamed("_x_scaled", "_x").select("_x", MD.S.ADMISSIONS).persist()


@pytest.mark.parametrize("block", [BO.BLOCK_ROWS, 500])
def test_trees_are_those_of_the_library(scaled, block, monkeypatch):
    monkeypatch.setattr(BO, "BLOCK_ROWS", block)  # several blocks: a job a level, sums added up
    monkeypatch.setattr(BO, "REBASE", 2)
    folds = {0: scaled, 1: scaled.limit(700)}
    got = BO.boosted(folds, "_x", MD.S.ADMISSIONS, MODELS, 16, 42)
    for number, rows in folds.items():
        x = np.array([r["_x"].toArray() for r in rows.collect()])
        for i, m in enumerate(MODELS):
            want = TR.flat_trees(MD.admissions_regressor(**m, maxBins=16).setFeaturesCol("_x").fit(rows.coalesce(1)))
            flat = got[number, i]
            assert len(flat.roots) == m["maxIter"] and (flat.weights == want.weights).all()
            first = 1 if block == 500 else m["maxIter"]  # later labels are no whole numbers: equal gains hang on the order of sums
            a, b = flat.values(x)[0], want.values(x)[0]
            np.testing.assert_allclose(a[:, :first], b[:, :first], rtol=1e-9, atol=1e-9)
            y = np.array([r[MD.S.ADMISSIONS] for r in rows.collect()])
            error = lambda v, w: (((v * w).sum(axis=1) - y) ** 2).mean()
            assert abs(error(a, flat.weights) - error(b, want.weights)) < 0.02 * error(b, want.weights) + 1e-9


def test_cuts_and_splits():
    assert BO.value_cuts(np.array([1.0, 2.0, 5.0]), np.array([4, 4, 4]), 5).tolist() == [1.5, 3.5]
    assert BO.value_cuts(np.array([1.0, 2.0, 3.0, 4.0]), np.array([5, 1, 1, 5]), 1).tolist() == [2.5]
    assert BO.value_cuts(np.array([1.0]), np.array([3]), 5).tolist() == []
    bins, y = np.array([[0, 0], [0, 1], [1, 0], [1, 1]]), np.array([0.0, 0.0, 4.0, 4.0])
    gain, feature, cut, left, right, own = BO.best_splits(BO.histograms(bins, y, np.zeros(4, int), 1, 2), np.array([1, 1]), None)
    assert (gain[0], feature[0], cut[0]) == (4.0, 0, 0)
    assert left[:, 0].tolist() == [2.0, 0.0, 0.0] and right[:, 0].tolist() == [2.0, 8.0, 32.0] and own[:, 0].tolist() == [4.0, 8.0, 32.0]


def test_a_whole_grid_takes_few_jobs(spark, scaled):
    daily = J.prepare_model_input(catalog.orders_features(spark, "/root/testdata/sf0.001")).persist()
    daily.count()
    tracker, group = spark.sparkContext.statusTracker(), "grid"
    spark.sparkContext.setJobGroup(group, "grid")
    try:
        candidates = {"maxIter": [10, 20], "stepSize": [0.1, 0.2], "maxDepth": [3, 4]}
        _, results = TU.grid_search(daily, J.default_features(daily), "admissions", candidates, 2, parallelism=1)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert results.count() == 8 * 2
    assert len(tracker.getJobIdsForGroup(group)) < 100  # with a fit a candidate: 8 fits of 20 rounds, each of 4 jobs or more


def test_cuts_come_from_all_rows(spark, monkeypatch):
    """More rows than Spark ML draws its cuts from: the cuts are those of all values, over many ranges."""
    r = np.random.default_rng(3)
    n = 12_000
    columns = [r.normal(size=n), r.integers(0, 5, n).astype(float), np.where(r.random(n) < 0.6, 7.0, r.normal(size=n) * 9), np.zeros(n), r.integers(0, 40, n).astype(float)]
    values = np.stack(columns, axis=1)
    rows = spark.createDataFrame([(x.tolist(),) for x in values], "v array<double>").select(array_to_vector("v").alias("x")).repartition(7).persist()
    got = BO.split_cuts(rows, "x", n, 32)
    for column, cuts in zip(columns, got, strict=True):
        assert cuts.tolist() == BO.value_cuts(*np.unique(column, return_counts=True), 31).tolist()
    monkeypatch.setattr(BO, "SPLIT_ROWS", n)
    for a, b in zip(got, BO.split_cuts(rows, "x", n, 32), strict=True):
        assert a.tolist() == b.tolist()


def test_a_grid_fits_on_all_rows(spark, monkeypatch):
    """No row of a fold is left out of its fits, however many there are."""
    daily = J.prepare_model_input(catalog.orders_features(spark, "/root/testdata/sf0.001")).persist()
    # A limit that holds unless the caller sets one, brought down to this table's size.
    monkeypatch.setattr(MD, "MAX_FIT_ROWS", 100, raising=False)
    monkeypatch.setattr(MD.fit_rows, "__defaults__", tuple(limit and 100 for limit in MD.fit_rows.__defaults__))
    fitted = {}
    whole = BO.boosted
    monkeypatch.setattr(BO, "boosted", lambda folds, *a: fitted.update({k: f.count() for k, f in folds.items()}) or whole(folds, *a))
    TU.grid_search(daily, J.default_features(daily), "admissions", {"maxIter": [1], "maxDepth": [1]}, 2, parallelism=1)
    days = daily.count()
    assert fitted == {0: days - 2 * (days // 3), 1: days - days // 3}
    model = MD.fit_admissions(daily, J.default_features(daily), maxIter=1, maxDepth=1)
    assert model.stages[-1].trees[0]._call_java("rootNode").impurityStats().count() == days
