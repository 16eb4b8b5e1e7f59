import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from daycast.plans import jobs as J
from daycast.plans import models as MD
from daycast.plans import catalog
from daycast.sources import readers as R


def test_csv_roundtrip_and_dates(spark, tmp_dir):
    df = spark.createDataFrame([("2024-01-02", 3.0), ("not a date", 4.0)], "date string, v double")
    path = R.write_table(df, tmp_dir, "in.csv", fmt="csv")
    back = R.read_csv(spark, path, "date string, v double").orderBy("v").collect()
    assert back[0].date == dt.datetime(2024, 1, 2) and back[1].date is None


def test_coerce_date_columns(spark):
    df = spark.createDataFrame([("2024-01-02 10:00", "2024-01-03", "x")],
                               "`Date d'arrivée` string, `Date de départ` string, other string")
    out = R.coerce_date_columns(df)
    types = dict(out.dtypes)
    assert types["Date d'arrivée"] == "timestamp" and types["Date de départ"] == "timestamp" and types["other"] == "string"


def test_read_by_extension(spark, tmp_dir):
    df = spark.createDataFrame([(1, "2024-01-01")], "a int, date string")
    p = R.write_table(df, tmp_dir, "t.parquet")
    assert R.read_by_extension(spark, p).first().date == dt.datetime(2024, 1, 1)
    j = R.write_json_result(df, tmp_dir, "t.json")
    assert R.read_by_extension(spark, j).count() == 1
    with pytest.raises(ValueError):
        R.read_by_extension(spark, os.path.join(tmp_dir, "t.xlsx"))


def test_latest_table(spark, tmp_dir):
    for name in ("a.csv", "b.csv"):
        with open(os.path.join(tmp_dir, name), "w") as fh:
            fh.write("date,v\n2024-01-01,1\n")
        time.sleep(1.1)
    assert R.latest_table(spark, tmp_dir).endswith("b.csv")
    assert R.read_latest(spark, tmp_dir).count() == 1
    with pytest.raises(FileNotFoundError):
        R.latest_table(spark, os.path.join(tmp_dir, "missing"))


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json"])
def test_newest_table_is_read_whole(spark, tmp_dir, fmt):
    rows = spark.range(1000).selectExpr("date_add(date'2024-01-01', cast(id % 300 as int)) AS date", "id")
    R.write_table(rows.limit(3), tmp_dir, "old", fmt)
    time.sleep(1.1)
    path = R.write_table(rows.repartition(5), tmp_dir, fmt=fmt)
    assert R.latest_table(spark, tmp_dir).split("/")[-1] == path.split("/")[-1]
    assert R.read_latest(spark, tmp_dir).count() == 1000


def test_attach_daily_dates(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 2.0), (2, 3.0)], "k int, v double")
    out = R.attach_daily_dates(df, "2024-01-10", "k").orderBy("k").collect()
    assert [r.date for r in out] == [dt.date(2024, 1, 8), dt.date(2024, 1, 9), dt.date(2024, 1, 10)]


def test_train_save_load_forecast(spark, tmp_dir):
    daily = J.prepare_model_input(catalog.orders_features(spark, "/root/testdata/sf0.001")).persist()
    res = J.train(daily, admission_params={"maxIter": 3}, occupancy_params={"numTrees": 3, "maxDepth": 5},
                  model_dir=tmp_dir)
    metrics = {(r.target, r.metric) for r in res.test_metrics.collect()}
    assert ("admissions", "r2") in metrics and ("occupancy", "mae") in metrics
    assert res.importances.count() == 20
    loaded = MD.load_latest_model(spark, tmp_dir)
    assert loaded.feature_names == res.model.feature_names
    assert loaded.admission_threshold == pytest.approx(res.model.admission_threshold)
    a = MD.predict(res.model, daily).select("predicted_admissions", "predicted_occupancy").collect()
    b = MD.predict(loaded, daily).select("predicted_admissions", "predicted_occupancy").collect()
    assert a == b
    out = J.forecast(spark, daily, tmp_dir, days=3, output_dir=os.path.join(tmp_dir, "out"))
    assert out["forecast"].count() == 3 and out["summary"].first().days == 3
    assert out["chart"].where(F.col("future")).count() == 3
    v = J.validate(loaded, daily, bins=5, gridsize=20)
    assert v["histogram"].count() == 10 and v["density"].count() == 40
    assert v["metrics"].count() == 12


def test_predict_requires_fitted_models(spark):
    with pytest.raises(ValueError):
        MD.predict(None, spark.range(1))


def test_same_seed_same_model(spark):
    daily = J.prepare_model_input(catalog.orders_features(spark, "/root/testdata/sf0.001")).persist()
    feats = J.default_features(daily)
    a = MD.fit_occupancy(daily, feats, numTrees=3).transform(daily).select("predicted_occupancy").collect()
    b = MD.fit_occupancy(daily, feats, numTrees=3).transform(daily).select("predicted_occupancy").collect()
    assert a == b


def test_depth_and_missing_thresholds_are_errors(spark, tmp_dir):
    with pytest.raises(ValueError):
        MD.occupancy_regressor(maxDepth=31)
    with pytest.raises(ValueError):
        MD.admissions_regressor(maxDepth=50)
    with pytest.raises(ValueError):
        MD.load_model(spark, "a", "b")
    rows = spark.range(2000).selectExpr("id", "id * 2 AS v")
    assert MD.fit_rows(rows, None) is rows and MD.fit_rows(rows, 5000) is rows
    assert 300 < MD.fit_rows(rows, 500).count() < 700


def test_visits_file_to_model_and_forecast(spark, tmp_dir):
    """A CSV of several parts, two series, day-first dates, a bad date, junk and missing measures."""
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    rows = []
    for s, shift in (("a", 0), ("b", 50)):
        for i, d in enumerate(days):
            for k in range(2 + (i + len(s)) % 3):
                text = d.strftime("%d/%m/%Y") if k % 2 else d.isoformat()
                rows.append((s, f"{s}{i}-{k}", text, f"{k} h", "junk" if (i + k) % 9 == 0 else f"{shift + 20 + i % 7},5 %", "Urgences" if k == 0 else "x"))
    rows.append(("a", "bad", "not a date", "1 h", "50%", "x"))
    columns = "ward string, Patient string, `Date d'arrivée` string, `Durée d'attente` string, `Taux d'occupation (lit)` string, `Type d'admissions` string"
    R.write_table(spark.createDataFrame(rows, columns).repartition(4), tmp_dir, "visits", "csv")
    res = J.train_from_visits(spark, f"{tmp_dir}/visits.csv", f"{tmp_dir}/out", ["ward"], admission_params={"maxIter": 2}, occupancy_params={"numTrees": 2, "maxDepth": 3})
    quality = {r.ward: r for r in spark.read.json(f"{tmp_dir}/out/processed/visit_quality").collect()}
    assert quality["a"].undated == 1 and quality["b"].undated == 0 and quality["b"].junk_occupancy > 0
    daily = R.read_latest(spark, f"{tmp_dir}/out/processed", extensions=(".parquet",))
    assert daily.count() == 80
    results = spark.read.json(res.results_path).first()
    assert "mae" in results.test_metrics and "admission_model" in results.model_paths
    loaded = MD.load_latest_model(spark, f"{tmp_dir}/out/models")
    assert loaded.series_cols == ("ward",)
    assert sorted((r.ward, r.threshold) for r in loaded.series_thresholds.collect()) == sorted((r.ward, r.threshold) for r in res.model.series_thresholds.collect())
    out = J.forecast(spark, f"{tmp_dir}/out/processed", loaded, 3, ["ward"], output_dir=f"{tmp_dir}/fc")
    assert out["forecast"].groupBy("ward").count().where("count = 3").count() == 2
    assert R.read_latest(spark, f"{tmp_dir}/fc", extensions=(".parquet",)).count() == 6


def test_text_csv_is_model_input(spark, tmp_dir):
    daily = catalog.events_features(spark, "/root/testdata/sf0.001")
    R.write_table(daily, tmp_dir, "daily", "csv")
    df = J.prepare_model_input(R.read_csv(spark, f"{tmp_dir}/daily.csv"), group_cols=["event_type"])
    types = dict(df.dtypes)
    assert types["totalAdmissions"] == types["admissionsLag1"] == "double" and types["month"] == "int" and types["date"] == "date"
    assert df.count() == daily.count()


def test_history_without_dates_keeps_series_apart(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(5)] + [("b", i, float(i)) for i in range(5)], "g string, k int, totalAdmissions double")
    got = J.load_history(spark, df, "2024-01-10", "k", ["g"]).collect()
    assert all({r.date for r in got if r.g == g} == {dt.date(2024, 1, 6) + dt.timedelta(days=i) for i in range(5)} for g in "ab")


def test_calendar_parts_come_from_the_date(spark):
    from daycast.operators import prepare as P

    df = spark.createDataFrame([(dt.date(2024, 7, 6), 5.0)], "date date, totalAdmissions double")
    r = P.default_missing_columns(df, ["month", "dayOfMonth", "year", "isWeekend", "other"], "history").first()
    assert (r.month, r.dayOfMonth, r.year, r.isWeekend, r.other) == (7, 6, 2024, 1, 0.0)
    lags = P.default_missing_columns(df, ["admissionsLag3", "occupancyLag1"], "lags")
    assert lags.first().admissionsLag3 == 5.0 and "occupancyLag1" not in lags.columns
    assert P.entry_default("avgOccupancyRate") == 80.0 and P.entry_default("occupancyLag9") == 75.0
