"""Several series at once give what each gives alone; null keys, constants and short series."""

import datetime as dt

import numpy as np
import pytest
from daycast.operators import daily as D
from daycast.operators import metrics as M
from daycast.operators import prepare as P
from daycast.operators import splits as SP
from daycast.operators.quantiles import exact_quantiles, modes
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

V = {"patient": "Patient", "arrival": "Date d'arrivée", "occupancy": "Taux d'occupation (lit)"}


def visits(spark, series):
    rows = []
    for g, low in series:
        for i in range(60):
            day = dt.datetime(2024, 1, 1) + dt.timedelta(days=i % 20 + i % 3)
            rows.append((g, i, day, None if i % 4 == 0 else f"{low + i % 9}%"))
    return spark.createDataFrame(rows, f"g string, Patient int, `{V['arrival']}` timestamp, `{V['occupancy']}` string")


def table(df):
    return sorted(map(str, (r.asDict() for r in df.drop("g").collect())))


def test_together_equals_alone(spark):
    pair = [(None, 10), ("b", 90)]
    both = D.build_daily_features(visits(spark, pair), ["g"])
    for g, low in pair:
        alone = D.build_daily_features(visits(spark, [(g, low)]))
        mine = both.where(both["g"].eqNullSafe(g)).select("g", *[c for c in alone.columns if c != "g"])
        assert table(mine) == table(alone.select(*[c for c in mine.columns if c != "g"]))
    prepared = P.prepare_visits(visits(spark, pair), group_cols=["g"])
    got = {r["g"]: r["m"] for r in prepared.where("Patient = 0").selectExpr("g", "occupancyRate AS m").collect()}
    assert got[None] < 20 and got["b"] > 89


def test_null_series_keeps_its_values(spark):
    day = dt.date(2024, 1, 1)
    daily = spark.createDataFrame([(None, day, 2.0, 5.0), (None, day + dt.timedelta(days=2), 3.0, 7.0)], "g string, date date, totalAdmissions double, avgOccupancyRate double")
    got = [(r.totalAdmissions, r.avgOccupancyRate) for r in D.densify_daily(daily, ["g"]).orderBy("date").collect()]
    assert got == [(2.0, 5.0), (0.0, None), (3.0, 7.0)]
    res = spark.createDataFrame([(None, 1.0), (None, 2.0), ("x", 3.0), ("x", 3.0)], "g string, residual double")
    hist = M.residual_histogram(res, bins=2, group_cols=["g"]).collect()
    assert sorted((r.g or "", r.bucket, r["count"]) for r in hist) == [("", 1, 1), ("", 2, 1), ("x", 1, 2), ("x", 2, 0)]


def test_keys_and_calendar_are_not_imputed(spark):
    df = spark.createDataFrame([(None, 1, None, 5.0), (1, 1, 3, None), (1, None, 3, 9.0)], "ward int, month int, k int, v double")
    got = P.impute_by_type(df, group_cols=["ward"]).collect()
    assert sorted((r.ward is None) for r in got) == [False, False, True] and sum(r.month is None for r in got) == 1
    assert {r.v for r in got if r.ward == 1} == {9.0}


def test_one_date_cuts_all_series(spark):
    rows = [("a", dt.date(2023, 1, 1) + dt.timedelta(days=i)) for i in range(50)] + [("b", dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, date date")
    got = SP.split_by_time(df, 0.2, ["g"], common=True).collect()
    assert max(r.date for r in got if r.split == "train") < min(r.date for r in got if r.split == "test")
    folds = SP.time_series_folds(df, 4, ["g"], common=True).collect()
    for i in range(4):
        assert max(r.date for r in folds if r.test_fold < i) < min(r.date for r in folds if r.test_fold == i)


def test_too_few_days_for_folds(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, i),) for i in (1, 2, 3)], "date date")
    with pytest.raises(Exception, match="folds need at least 4 days"):
        SP.time_series_folds(df, 3).collect()


def test_constant_and_empty_groups(spark):
    df = spark.createDataFrame([("c", 1.0, 1.0), ("c", 2.0, 2.0), ("n", None, 1.0), ("v", 1.0, 2.0), ("v", 3.0, 3.5)], "g string, y double, p double")
    got = {(r.g, r.metric): r.value for r in M.extended_metrics(df, {"t": ("y", "p")}, ["g"]).collect()}
    assert got["n", "mape"] is None and got["n", "mse"] is None and got["c", "mape"] == 0.0 and got["v", "mae"] == 0.75
    res = df.selectExpr("g", "y - p AS residual")
    dens = M.residual_density(res, gridsize=5, group_cols=["g"])
    assert {r.g for r in dens.collect()} == {"v"}
    assert M.residual_density(res.where("g = 'c'"), gridsize=5).count() == 0
    assert M.residual_histogram(res.where("g = 'n'")).count() == 0
    flat = M.residual_histogram(res.where("g = 'c'"), bins=3).collect()
    assert [(r.bucket, r["count"]) for r in sorted(flat, key=lambda r: r.bucket)] == [(1, 2), (2, 0), (3, 0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-20, 20).map(float)), min_size=1, max_size=40), st.sampled_from([10, 10_000]))
def test_quantiles_equal_numpy(spark, values, accuracy):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0], accuracy=accuracy).first()
    real = [v for v in values if v is not None]
    assert got.n == len(real)
    if real:
        assert np.allclose(got.q, np.quantile(real, [0.0, 0.25, 0.5, 0.9, 1.0]))
    else:
        assert got.q == [None] * 5


def test_bracketed_quantiles_of_many_values(spark):
    r = np.random.default_rng(4)
    a, b = r.normal(size=20000), np.round(r.exponential(size=5000), 1)
    df = spark.createDataFrame([("a", float(x)) for x in a] + [(None, float(x)) for x in b], "g string, v double")
    got = {x.g: x.q for x in exact_quantiles(df, "v", [0.25, 0.5, 0.75], ["g"], accuracy=200).collect()}
    assert np.allclose(got["a"], np.quantile(a, [0.25, 0.5, 0.75])) and np.allclose(got[None], np.quantile(b, [0.25, 0.5, 0.75]))


def test_modes(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("a", 1), (None, 7), ("z", None)], "g string, v int")
    assert sorted((r.g or "", r["mode"]) for r in modes(df, "v", ["g"]).collect()) == [("", 7), ("a", 1)]


def test_cluster_without_a_checkpoint_folder_is_an_error(monkeypatch):
    from daycast import session

    class Fake:
        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

            @staticmethod
            def getConf():
                return {}

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Fake)


def test_written_tables_can_be_cleared(spark):
    import os

    from daycast import session

    before = session._WRITTEN.pop(spark.sparkContext.applicationId, [])
    table = session.materialize(spark.range(5), "cleared")
    path = session._WRITTEN[spark.sparkContext.applicationId][0]
    assert table.count() == 5 and os.path.isdir(path.removeprefix("file:"))
    assert session.clear_tables(spark) == 1 and not os.path.exists(path.removeprefix("file:"))
    session._WRITTEN[spark.sparkContext.applicationId] = before
