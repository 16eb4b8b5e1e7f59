"""Physical-plan checks: what must hold for the flagship plan to survive 1000x data."""

import re

from daycast.plans import catalog


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + "\n" + df._jdf.queryExecution().optimizedPlan().toString()


def test_flagship_plan_shape(spark):
    df = catalog.q_build_daily_features(spark, "/root/testdata/sf0.001")
    txt = plan_text(df)
    # No cartesian products or nested-loop joins anywhere.
    assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt
    # Scans read only the columns in use.
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan().toString()):
        assert "l_extendedprice" not in schema and "o_custkey" not in schema and "l_comment" not in schema


def test_raw_path_aggregates_partially(spark):
    from daycast.operators import daily as D
    from daycast.operators import prepare as P
    from daycast.sources import tables as T
    visits = P.enrich_visits(T.visits_from_orders(spark, "/root/testdata/sf0.001"))
    daily = D.aggregate_daily(visits)
    txt = daily._jdf.queryExecution().executedPlan().toString()
    # map-side (partial) aggregation happens before every shuffle of raw rows
    raw = txt[: txt.index("FileScan")] if "FileScan" in txt else txt
    assert txt.count("partial_count") >= 2 and raw.index("partial_count") > raw.index("Exchange")
    assert "collect_list" not in txt and "CartesianProduct" not in txt


def test_skewed_series_stays_bounded(spark):
    """One series holding a third of all visits: the daily table still has one row per day."""
    from pyspark.sql import functions as F

    from daycast.operators import daily as D
    from daycast.sources import tables as T
    ev = T.visits_from_events(spark, "/root/testdata/sf0.001")
    hot = ev.withColumn("event_type", F.when(F.col("Patient") % 3 == 0, F.lit("hot")).otherwise(F.col("event_type")))
    out = D.build_daily_features(hot, ["event_type"])
    per = {r.event_type: r.n for r in out.groupBy("event_type").agg(F.count("*").alias("n")).collect()}
    days = out.select("date").distinct().count()
    assert per["hot"] <= days and all(v <= days for v in per.values())


def test_no_keyless_percentile_or_mode(spark):
    """Exact medians, quartiles and modes rank only what a sketch brackets."""
    from pyspark.sql import functions as F

    from daycast.operators import metrics as M
    from daycast.operators import prepare as P
    df = spark.range(1000).select("id", F.when(F.col("id") % 7 != 0, F.col("id") * 1.0).alias("v"), F.col("id").cast("string").alias("t"))
    for out in (P.impute_median(df, ["v"]), P.impute_mode(df, ["v"]), M.iqr_threshold(df, "v"), M.iqr_threshold(df, "v", group_cols=["t"])):
        txt = out._jdf.queryExecution().executedPlan().toString()
        assert "percentile(" not in txt and "mode(" not in txt and "CartesianProduct" not in txt


def reads_of(spark, monkeypatch, table, build):
    """How often ``build()``'s result reads ``table``, by rows that pass its scan, and the jobs it takes."""
    from daycast.sources import tables as T

    plain, passed = T.load, spark.sparkContext.accumulator(0)

    def counted(spark, sf_dir, name):
        df = plain(spark, sf_dir, name)
        if name != table:
            return df

        def run(batches):
            for batch in batches:
                passed.add(batch.num_rows)
                yield batch

        return df.mapInArrow(run, df.schema)

    monkeypatch.setattr(T, "load", counted)
    sc = spark.sparkContext
    group = f"reads-{id(build)}"
    sc.setJobGroup(group, group)
    try:
        build().collect()
        return passed.value / plain(spark, "/root/testdata/sf0.001", table).count(), len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setJobGroup("", "")


def test_statistics_read_the_visits_once(spark, monkeypatch):
    from daycast.operators import daily as D
    from daycast.operators import prepare as P
    from daycast.sources import tables as T

    sf = "/root/testdata/sf0.001"
    visits = P.enrich_visits(T.visits_from_orders(spark, sf))
    cols = list(P.IMPUTED_VISIT_COLUMNS)
    assert P.columns_with_nulls(visits, cols) == cols
    # The daily series: once, medians of three columns included.
    reads, _ = reads_of(spark, monkeypatch, "lineitem", lambda: D.build_daily_features(T.visits_from_orders(spark, sf)))
    assert reads == 1
    # All visits: once for the statistics, once for the result, whatever the number of columns.
    jobs = set()
    for some in (cols[:1], cols):
        monkeypatch.undo()
        reads, n = reads_of(spark, monkeypatch, "lineitem", lambda: P.impute_median(P.enrich_visits(T.visits_from_orders(spark, sf)), some))
        assert reads == 2
        jobs.add(n)
    assert len(jobs) == 1  # no job of their own for further columns
    monkeypatch.undo()
    reads, _ = reads_of(spark, monkeypatch, "lineitem", lambda: P.impute_mode(P.enrich_visits(T.visits_from_orders(spark, sf)), cols))
    assert reads == 2


def test_modes_are_one_count(spark):
    """Columns of several types are counted by value in one pass."""
    from daycast.operators.quantiles import modes_of

    df = spark.createDataFrame([("a", 1, "x", 2.5), ("a", 1, "y", None), ("a", 2, "y", 0.5), (None, None, None, None), ("b", 7, None, 1.0)], "g string, i int, t string, d double")
    got = {r.g: (r.i, r.t, r.d) for r in modes_of(df, ["i", "t", "d"], ["g"]).collect()}
    assert got == {"a": (1, "y", 0.5), "b": (7, None, 1.0)}
    assert modes_of(df, ["i", "t"]).collect() == [(1, "y")]
    plan = modes_of(df, ["i", "t", "d"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1
