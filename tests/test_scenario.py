import datetime as dt

import numpy as np

from daycast.operators import scenario as SC


def test_interval_uplift_matches_loop(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(20)]
    adm = [float(10 + i % 4) for i in range(20)]
    occ = [70.0 + i * 1.7 for i in range(20)]
    series = spark.createDataFrame(list(zip(days, adm, occ)), "date date, totalAdmissions double, avgOccupancyRate double")
    intervals = [(1, days[2], 5), (2, days[4], 7), (3, days[18], 9)]
    iv = spark.createDataFrame(intervals, "seq int, start date, duration int")
    out = {r.date: r for r in SC.interval_uplift(series, iv, 1.5, 1.2, 100.0).collect()}
    a, o = np.array(adm), np.array(occ)
    for _, start, dur in intervals:  # plain loop: multiply and round at each application
        i = days.index(start)
        j = min(i + dur, len(days))
        a[i:j] = np.round(a[i:j] * 1.5)
        o[i:j] = np.round(np.clip(o[i:j] * 1.2, 0, 100), 1)
    for k, d in enumerate(days):
        assert out[d].totalAdmissionsPeak == a[k]
        assert out[d].avgOccupancyRatePeak == o[k]
    assert out[days[5]].peaks == 2


def test_zscore(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    z = sorted(r.zscore for r in SC.zscore(df, "x", 3.0).collect())
    assert z == [-3.0, 0.0, 3.0]


def test_zscore_of_constant_and_single_values(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 5.0), ("b", 1.0), (None, 2.0), (None, 4.0)], "g string, x double")
    got = sorted((r.g or "", r.zscore) for r in SC.zscore(df, "x", 1.0, ["g"]).collect() if r.zscore is not None)
    assert [g for g, _ in got] == ["", "", "a", "a"] and got[2][1] == 0.0 and abs(got[1][1]) > 0.7
