import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from daycast.operators import alerts as AL
from daycast.operators import metrics as M
from daycast.operators import splits as SP


@pytest.fixture
def pairs(spark):
    rng = np.random.default_rng(7)
    y = rng.normal(50, 10, 200)
    yh = y + rng.normal(0, 3, 200)
    y[5] = 0.0
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), float(a), float(b)) for i, (a, b) in enumerate(zip(y, yh))]
    return spark.createDataFrame(rows, "date date, y double, yh double"), y, yh


def test_metrics_equal_evaluator_and_numpy(pairs):
    df, y, yh = pairs
    m = {(r.metric): r.value for r in M.extended_metrics(df, {"t": ("y", "yh")}).collect()}
    for name in ("mse", "rmse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="y", predictionCol="yh", metricName=name).evaluate(df)
        assert m[name] == pytest.approx(ev, rel=1e-9)
    e = y - yh
    assert m["mape"] == pytest.approx(np.mean(np.abs(e) / np.maximum(np.abs(y), np.finfo(float).eps)), rel=1e-9)
    assert m["explained_variance"] == pytest.approx(1 - np.var(e) / np.var(y), rel=1e-9)


def test_constant_target_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, yh double")
    m = {r.metric: r.value for r in M.regression_metrics(df, {"t": ("y", "yh")}).collect()}
    assert m["r2"] == 1.0
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, yh double")
    m = {r.metric: r.value for r in M.regression_metrics(df, {"t": ("y", "yh")}).collect()}
    assert m["r2"] == 0.0


def test_iqr_threshold(pairs):
    df, y, _ = pairs
    r = M.iqr_threshold(df, "y").first()
    q25, q75 = np.percentile(y, [25, 75])
    assert (r.q25, r.q75) == (pytest.approx(q25), pytest.approx(q75))
    assert r.threshold == pytest.approx(q75 + 1.5 * (q75 - q25))


def test_histogram_and_density(pairs):
    df, y, yh = pairs
    r = M.residuals(df, "y", "yh")
    h = M.residual_histogram(r, bins=8).orderBy("bucket").collect()
    counts, _ = np.histogram(y - yh, bins=8)
    assert [x["count"] for x in h] == counts.tolist()
    d = M.residual_density(r, gridsize=100, cut=3).orderBy("grid_index").collect()
    xs = np.array([x.x for x in d])
    dens = np.array([x.density for x in d])
    assert np.trapezoid(dens, xs) == pytest.approx(1.0, abs=0.02)
    e = y - yh
    bw = np.std(e, ddof=1) * len(e) ** -0.2
    ref = np.mean(np.exp(-0.5 * ((xs[10] - e) / bw) ** 2)) / (bw * math.sqrt(2 * math.pi))
    assert dens[10] == pytest.approx(ref, rel=1e-9)


def test_split_by_time(spark):
    df = spark.range(10).select(F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("date"))
    rows = SP.split_by_time(df, 0.2).orderBy("date").collect()
    assert [r.split for r in rows] == ["train"] * 8 + ["test"] * 2
    train, test = SP.train_test(df, 0.25)
    assert train.count() == 7 and test.count() == 3
    assert train.agg(F.max("date")).first()[0] < test.agg(F.min("date")).first()[0]


def test_time_series_folds_match_expanding_rule(spark):
    n, k = 23, 5
    df = spark.range(n).select(F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("date"))
    lab = SP.time_series_folds(df, k).cache()
    s = n // (k + 1)
    for i in range(k):
        train, test = SP.fold_frames(lab, i)
        start = n - (k - i) * s
        assert sorted(r._row for r in test.collect()) == list(range(start, start + s))
        assert sorted(r._row for r in train.collect()) == list(range(0, start))


def test_random_split_is_stable(spark):
    df = spark.range(50).select(F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("date"))
    a = {r.date: r.split for r in SP.random_split(df, 0.2, 1).collect()}
    b = {r.date: r.split for r in SP.random_split(df.repartition(5), 0.2, 1).collect()}
    assert a == b and sum(v == "test" for v in a.values()) == 10


def test_alert_rows(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 12.25, 95.0), (dt.date(2024, 1, 2), 5.0, 90.25)],
                               "date date, predicted_admissions double, predicted_occupancy double")
    rows = AL.alert_rows(df, AL.default_rules(10.0)).orderBy("date", "type").collect()
    assert [(r.date, r.type) for r in rows] == [("2024-01-01", "admissions"), ("2024-01-01", "occupancy"),
                                                ("2024-01-02", "occupancy")]
    assert rows[0].message == "⚠️ Pic d'admissions prévu: 12.2 admissions"
    assert rows[2].message == "⚠️ Taux d'occupation critique prévu: 90.2%"
    flags = AL.flag_alerts(df, AL.default_rules(10.0)).orderBy("date").collect()
    assert [(r.admission_alert, r.occupancy_alert) for r in flags] == [(True, True), (False, True)]
