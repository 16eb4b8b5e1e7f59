import datetime as dt

from pyspark.sql import functions as F

from daycast.functions import columns as C


def test_text_parsing(spark):
    df = spark.createDataFrame(
        [("3 h", "75%", "Urgences"), ("12h30", "80%%", "Autre"), ("none", "junk", None), (None, "75,5 %", "Urgences")],
        "w string, p string, t string",
    )
    rows = df.select(
        C.first_number("w").alias("w"), C.parse_percent("p").alias("p"), C.equals_flag("t", "Urgences").alias("e")
    ).collect()
    assert [r.w for r in rows] == [3.0, 12.0, None, None]
    assert [r.p for r in rows] == [75.0, 80.0, None, 75.5]
    assert [r.e for r in rows] == [1, 0, 0, 1]


def test_duration_and_calendar(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 7, 12), dt.datetime(2024, 1, 6, 0))], "a timestamp, b timestamp")
    r = df.select(C.duration_days("a", "b").alias("d"), *[v.alias(k) for k, v in C.calendar_columns("a").items()]).first()
    assert r.d == -1.5
    assert (r.dayOfWeek, r.isWeekend, r.isWinter, r.isSummer, r.month, r.dayOfMonth, r.year) == (6, 1, 1, 0, 1, 7, 2024)


def test_season_label_and_factor(spark):
    rows = spark.range(1, 13).select(F.col("id").cast("int").alias("m")).select(
        "m", C.season_label("m").alias("s")).collect()
    labels = {r.m: r.s for r in rows}
    assert labels[12] == labels[1] == "Hiver" and labels[7] == "Été" and labels[4] == "Printemps" and labels[10] == "Automne"
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 7, 6),), (dt.date(2024, 4, 3),)], "d date")
    f = [r.f for r in df.select(C.calendar_factor("d", {1: 1.3, 7: 0.9}, {0: 1.1, 5: 0.8}).alias("f")).collect()]
    assert f == [1.3 * 1.1, 0.9 * 0.8, 1.0]


def test_rounding_and_format(spark):
    vals = [0.15, 0.25, 2.5, 3.5, 90.25, 1234567.85, -0.15]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    rows = df.select("v", C.round_half_even("v", 0).alias("r0"), C.round_half_even("v", 1).alias("r1"),
                     C.format_fixed("v", 1).alias("s")).collect()
    import numpy as np
    for r in rows:
        assert r.r0 == float(np.round(r.v)), r
        assert r.r1 == float(np.round(r.v, 1)), r
        assert r.s == f"{r.v:.1f}", r


def test_date_formats(spark):
    df = spark.createDataFrame([("15/03/2024",), ("2024-03-15 10:00",), ("15/03/2024 08:30",), ("junk",), (None,)], "t string")
    got = [r.d for r in df.select(C.parse_timestamp("t", ("dd/MM/yyyy HH:mm", "dd/MM/yyyy")).alias("d")).collect()]
    assert got == [dt.datetime(2024, 3, 15), dt.datetime(2024, 3, 15, 10), dt.datetime(2024, 3, 15, 8, 30), None, None]
