"""M8 against a plain-Python loop of the forecasting rules, using a stub model."""

import datetime as dt

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer

from daycast.plans import forecast as FC
from daycast.plans.models import ForecastModel

FEATS = ["dayOfWeek", "admissionsLag1", "admissionsLag3", "admissionsLag7", "admissionsMA7Prev",
         "occupancyLag1", "occupancyLag3", "occupancyLag7", "occupancyMA7Prev", "waitingHours"]


def stub_model():
    adm = PipelineModel(stages=[SQLTransformer(statement=(
        "SELECT *, 0.5 * admissionsLag1 + 0.2 * admissionsLag3 + 0.1 * admissionsLag7 + 0.3 * admissionsMA7Prev "
        "+ dayOfWeek + 0.01 * waitingHours AS predicted_admissions FROM __THIS__"))])
    occ = PipelineModel(stages=[SQLTransformer(statement=(
        "SELECT *, 0.6 * occupancyLag1 + 0.1 * occupancyLag3 + 0.2 * occupancyLag7 + 0.15 * occupancyMA7Prev "
        "AS predicted_occupancy FROM __THIS__"))])
    return ForecastModel(adm, occ, FEATS, admission_threshold=12.0, occupancy_threshold=90.0)


def python_loop(y_adm, y_occ, last_date, days):
    out, p_adm, p_occ = [], [], []
    for i in range(1, days + 1):
        d = last_date + dt.timedelta(days=i)
        if i == 1:
            def lags(y):
                l1 = y[-1]
                return l1, (y[-3] if len(y) >= 3 else l1), (y[-7] if len(y) >= 7 else l1), sum(y[-7:]) / len(y[-7:])
            a, o = lags(y_adm), lags(y_occ)
        else:
            k = min(i - 1, 7)

            def lags(y, p):
                prev = p[-k:]
                l1 = prev[-1]
                vals = prev if k >= 7 else y[-(7 - k):] + prev
                return l1, (prev[-3] if k >= 3 else l1), (prev[-7] if k >= 7 else l1), sum(vals) / len(vals)
            a, o = lags(y_adm, p_adm), lags(y_occ, p_occ)
        pa = 0.5 * a[0] + 0.2 * a[1] + 0.1 * a[2] + 0.3 * a[3] + d.weekday() + 0.01 * 80.0
        po = 0.6 * o[0] + 0.1 * o[1] + 0.2 * o[2] + 0.15 * o[3]
        p_adm.append(pa)
        p_occ.append(po)
        out.append((d, a, o, pa, po, pa >= 12.0, po >= 90.0))
    return out


@pytest.mark.parametrize("n_hist", [2, 5, 12])
def test_forecast_matches_loop(spark, n_hist):
    start = dt.date(2024, 3, 1)
    hist = [(start + dt.timedelta(days=i), float(8 + (i * 7) % 5), 70.0 + (i * 3) % 11) for i in range(n_hist)]
    df = spark.createDataFrame(hist, "date date, totalAdmissions double, avgOccupancyRate double")
    fc = FC.forecast_recursive(stub_model(), df, days=12, checkpoint_every=4).orderBy("date").collect()
    ref = python_loop([h[1] for h in hist], [h[2] for h in hist], hist[-1][0], 12)
    assert len(fc) == 12
    for r, (d, a, o, pa, po, aa, oa) in zip(fc, ref):
        assert r.date == d
        assert (r.admissionsLag1, r.admissionsLag3, r.admissionsLag7) == pytest.approx(a[:3])
        assert (r.occupancyLag1, r.occupancyLag3, r.occupancyLag7) == pytest.approx(o[:3])
        assert r.admissionsMA7 == pytest.approx(a[3]) and r.occupancyMA7 == pytest.approx(o[3])
        assert r.predicted_admissions == pytest.approx(pa) and r.predicted_occupancy == pytest.approx(po)
        assert (r.admission_alert, r.occupancy_alert) == (aa, oa)


def test_forecast_many_series_at_once(spark):
    rows = []
    for s, base in (("a", 5.0), ("b", 20.0)):
        for i in range(10):
            rows.append((s, dt.date(2024, 1, 1) + dt.timedelta(days=i), base + i, 60.0 + i))
    df = spark.createDataFrame(rows, "s string, date date, totalAdmissions double, avgOccupancyRate double")
    fc = FC.forecast_recursive(stub_model(), df, days=5, group_cols=["s"]).collect()
    assert sorted((r.s, r.date.day) for r in fc) == [(s, d) for s in "ab" for d in range(11, 16)]
    for s, base in (("a", 5.0), ("b", 20.0)):
        one = df.where(f"s = '{s}'").drop("s")
        single = {r.date: r.predicted_admissions for r in FC.forecast_recursive(stub_model(), one, 5).collect()}
        for r in fc:
            if r.s == s:
                assert r.predicted_admissions == pytest.approx(single[r.date])


def test_future_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 27),)], "date date")
    out = FC.future_calendar(df, 3).orderBy("step").collect()
    assert [(r.date, r.dayOfMonth, r.month) for r in out] == [
        (dt.date(2024, 2, 28), 28, 2), (dt.date(2024, 2, 29), 29, 2), (dt.date(2024, 3, 1), 1, 3)]


def test_history_lag_mode_matches_loop(spark):
    start = dt.date(2024, 3, 1)
    hist = [(start + dt.timedelta(days=i), float(8 + (i * 7) % 5), 70.0 + (i * 3) % 11) for i in range(4)]
    df = spark.createDataFrame(hist, "date date, totalAdmissions double, avgOccupancyRate double")
    fc = FC.forecast_recursive(stub_model(), df, days=9, lag_mode="history").orderBy("date").collect()
    ya, yo = [h[1] for h in hist], [h[2] for h in hist]
    for i, r in enumerate(fc, start=1):
        def lags(seq):
            l1 = seq[-1]
            return l1, (seq[-3] if len(seq) >= 3 else l1), (seq[-7] if len(seq) >= 7 else l1), sum(seq[-7:]) / len(seq[-7:])
        a, o = lags(ya), lags(yo)
        d = hist[-1][0] + dt.timedelta(days=i)
        pa = 0.5 * a[0] + 0.2 * a[1] + 0.1 * a[2] + 0.3 * a[3] + d.weekday() + 0.8
        po = 0.6 * o[0] + 0.1 * o[1] + 0.2 * o[2] + 0.15 * o[3]
        assert (r.admissionsLag1, r.admissionsLag3, r.admissionsLag7, r.admissionsMA7) == pytest.approx(a)
        assert r.predicted_admissions == pytest.approx(pa) and r.predicted_occupancy == pytest.approx(po)
        ya.append(pa)
        yo.append(po)
