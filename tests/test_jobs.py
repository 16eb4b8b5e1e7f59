"""Saved models and jobs around them: only committed models are found, headers of any name, entries by hand."""

import datetime as dt
import json

import pytest
from daycast.plans import catalog as C
from daycast.plans import jobs as J
from daycast.plans import models as MD
from daycast.sources import readers as R


def test_a_half_written_model_is_never_the_newest(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        MD.load_latest_model(spark, tmp_dir)
    MD.save_model(C.linear_model(1.0), spark, tmp_dir)
    MD.save_model(C.linear_model(2.0), spark, tmp_dir)
    half = MD._paths(tmp_dir, "model_99990101_000000")
    C.linear_model().admission_model.write().save(half["admission_model"])
    assert MD.load_latest_model(spark, tmp_dir).admission_threshold == 2.0


def test_other_failures_to_read_are_not_hidden(spark, tmp_dir):
    paths = MD.save_model(C.linear_model(1.0), spark, tmp_dir)
    import shutil

    shutil.rmtree(paths["occupancy_model"])
    with pytest.raises(Exception) as caught:
        MD.load_latest_model(spark, tmp_dir)
    assert not isinstance(caught.value, FileNotFoundError)


def test_thresholds_of_series_are_named_in_the_record(spark, tmp_dir):
    model = C.linear_model(None)
    model.series_thresholds = spark.createDataFrame([("a", 3.0), (None, 4.0)], "g string, threshold double")
    model.series_cols = ("g",)
    MD.save_model(model, spark, tmp_dir, "model_x")
    record = spark.read.json(f"{tmp_dir}/model_x_metadata").first()
    assert record.thresholds == "model_x_thresholds"
    loaded = MD.load_latest_model(spark, tmp_dir)
    assert sorted((r.g or "", r.threshold) for r in loaded.series_thresholds.collect()) == [("", 4.0), ("a", 3.0)]


def test_visits_with_other_headers(spark, tmp_dir):
    rows = [("1", "05/01/2024 10:00", "07/01/2024", "3 h"), ("2", "2024-01-06", None, "x")]
    R.write_table(spark.createDataFrame(rows, "nr string, came string, went string, queue string"), tmp_dir, "v", "csv")
    names = {"patient": "nr", "arrival": "came", "departure": "went", "waiting": "queue"}
    got = J.read_visits(spark, f"{tmp_dir}/v.csv", names=names)
    assert dict(got.dtypes)["came"] == dict(got.dtypes)["went"] == "timestamp"
    assert [r.came.date() for r in got.orderBy("nr").collect()] == [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]


def test_entries_take_defaults_and_raise_alerts(spark):
    entries = spark.createDataFrame([(dt.date(2024, 5, 6), 30.0), (dt.date(2024, 5, 7), -100.0)], "date date, admissionsLag1 double")
    out = J.predict_entries(C.linear_model(20.0, 200.0), entries)
    got = {r.date.day: (r.predicted_admissions, r.admission_alert) for r in out["predictions"].collect()}
    assert got == {6: (pytest.approx(15 + 16 + 20 + 0.1), True), 7: (pytest.approx(-50 + 36 + 0.1), False)}
    assert [r.type for r in out["alerts"].collect()] == ["admissions"]


def test_a_forecast_run_leaves_its_record(spark, tmp_dir):
    history = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=i), 5.0 + i, 60.0) for i in range(9)], "date date, totalAdmissions double, avgOccupancyRate double")
    J.forecast(spark, history, C.linear_model(), 4, output_dir=tmp_dir)
    run = spark.read.json(f"{tmp_dir}/run_*").first()
    assert (run.first_day, run.last_day, run.days, run.model_version) == ("2024-01-10", "2024-01-13", 4, "1.0")
    paths = json.loads(run.paths)
    assert spark.read.parquet(paths["predictions"]).count() == 4 and set(paths) == {"predictions", "alerts", "summary"}
