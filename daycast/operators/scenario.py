"""What-if overlays on a daily series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daycast import schema as S
from daycast.functions import columns as C
from daycast.operators.keys import join_series
from daycast.operators.metrics import attach_stats
from daycast.operators.quantiles import exact_quantiles


def zscore(df: DataFrame, col: str, k: float = 1.0, group_cols=(), out: str = "zscore") -> DataFrame:
    """(x - mean) / sample std * k per series.

    A constant series has 0 everywhere, a series of one value null.
    """
    stats = df.groupBy(*group_cols).agg(F.avg(col).alias("_mean"), F.stddev_samp(col).alias("_sd"))
    joined = attach_stats(df, stats, group_cols)
    gap = F.col(col) - F.col("_mean")
    z = F.when(F.col("_sd") == 0, gap * 0.0).otherwise(F.try_divide(gap, F.col("_sd")) * F.lit(float(k)))
    return joined.withColumn(out, z).drop("_mean", "_sd")


def calendar_means(series: DataFrame, col: str = S.ADMISSIONS, group_cols=(), date_col: str = S.DATE) -> DataFrame:
    """Per series, a month's and a weekday's (Monday = 0) mean of ``col`` over the series' mean: part, key, factor.

    One pass over the daily rows; at most 19 rows a series. A series whose mean is 0 has null factors.
    """
    d = F.col(date_col)
    parts = F.array(*[F.struct(F.lit(name).alias("part"), key.cast("int").alias("key"))
                      for name, key in (("all", F.lit(0)), ("month", F.month(d)), ("weekday", F.weekday(d)))])
    means = series.select(*group_cols, F.col(col).cast("double").alias("_x"), F.inline(parts)).groupBy(*group_cols, "part", "key").agg(F.avg("_x").alias("_m"))
    whole = F.max(F.when(F.col("part") == "all", F.col("_m"))).over(Window.partitionBy(*group_cols))
    return means.withColumn("factor", F.try_divide("_m", whole)).where(F.col("part") != "all").select(*group_cols, "part", "key", "factor")


def observed_factor(series: DataFrame, col: str = S.ADMISSIONS, group_cols=(), date_col: str = S.DATE, out: str = "calendarFactor") -> DataFrame:
    """P19 with factors from the data: ``series`` with the product of its month's and weekday's :func:`calendar_means`."""
    g, means = list(group_cols), calendar_means(series, col, group_cols, date_col)
    found = series.withColumns({"_month": F.month(date_col), "_weekday": F.weekday(date_col)})
    for part in ("month", "weekday"):
        found = join_series(found, means.where(F.col("part") == part).select(*g, F.col("key").alias(f"_{part}"), F.col("factor").alias(f"_f_{part}")), [*g, f"_{part}"])
    return found.withColumn(out, F.col("_f_month") * F.col("_f_weekday")).drop("_month", "_weekday", "_f_month", "_f_weekday")


def peak_factors(series: DataFrame, threshold: str, shares=(0.05, 0.95), group_cols=(), admissions: str = S.ADMISSIONS, occupancy: str = S.OCCUPANCY) -> DataFrame:
    """Per series, what its own peak days say: one row with

    adm_factor, occ_factor: mean of the days with admissions at or above the column
    ``threshold`` over the mean of all days (1 without such a day); lo, hi: the
    occupancy's quantiles at ``shares``; spread: its sample deviation.
    """
    g = list(group_cols)
    peak = F.col(admissions) >= F.col(threshold)
    ratio = lambda c: F.coalesce(F.try_divide(F.avg(F.when(peak, F.col(c))), F.avg(c)), F.lit(1.0))
    stats = series.groupBy(*g).agg(ratio(admissions).alias("adm_factor"), ratio(occupancy).alias("occ_factor"), F.stddev_samp(occupancy).alias("spread"))
    bounds = exact_quantiles(series, occupancy, shares, g).select(*g, F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"))
    return attach_stats(stats, bounds, g)


def calendar_scale(df: DataFrame, factor: Column, col: str = S.ADMISSIONS, out: str = "scenarioAdmissions",
                   decimals: int = 0) -> DataFrame:
    """Value x a caller's calendar ``factor``, rounded half-even."""
    return df.withColumns({"calendarFactor": factor, out: C.round_half_even(F.col(col) * factor, decimals)})


def peak_intervals(series: DataFrame, col: str, threshold, duration: int = 7, group_cols=(),
                   date_col: str = S.DATE) -> DataFrame:
    """Intervals ``(seq, start, duration)`` starting on every day where ``col`` >= threshold."""
    thr = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    w = Window.partitionBy(*group_cols).orderBy(date_col)
    return series.where(F.col(col) >= thr).select(
        *group_cols,
        F.row_number().over(w).alias("seq"),
        F.col(date_col).alias("start"),
        F.lit(int(duration)).alias("duration"),
    )


def interval_uplift(series: DataFrame, intervals: DataFrame, adm_factor, occ_factor, occ_cap,
                    group_cols=(), date_col: str = S.DATE, admissions: str = S.ADMISSIONS,
                    occupancy: str = S.OCCUPANCY) -> DataFrame:
    """Days inside [start, start + duration) get an overlay, once per covering interval.

    Admissions are multiplied and rounded, occupancy is multiplied, clipped to
    [0, ``occ_cap``] and rounded to one decimal, at every application. The factors and
    the cap are numbers or columns of ``series``, the same for every interval of a
    series, so the result depends only on the number k of intervals covering a day: intervals are expanded to their days (at most
    ``duration`` rows each), counted per (series, day) with partial aggregation,
    joined to the series, and the overlay is folded k times.
    """
    g = list(group_cols)
    days = intervals.where(F.col("duration") >= 1).select(
        *g,
        F.explode(F.sequence(F.col("start").cast("date"),
                             F.date_add(F.col("start").cast("date"), F.col("duration") - 1))).alias(date_col),
    )
    cover = days.groupBy(*g, date_col).agg(F.count(F.lit(1)).alias("peaks"))
    out = join_series(series, cover, [*g, date_col]).withColumn("peaks", F.coalesce(F.col("peaks"), F.lit(0)))
    steps = F.sequence(F.lit(1), F.greatest(F.col("peaks"), F.lit(1)))

    def fold(col, fn):
        return F.when(F.col("peaks") > 0, F.aggregate(steps, F.col(col).cast("double"), lambda acc, _: fn(acc))) \
                .otherwise(F.col(col).cast("double"))

    return out.withColumns({
        f"{admissions}Peak": fold(admissions, lambda a: F.rint(a * F.lit(adm_factor))),
        f"{occupancy}Peak": fold(occupancy, lambda a: C.clip_round(a * F.lit(occ_factor), 0.0, occ_cap, 1)),
    })


def scenario(series: DataFrame, intervals: DataFrame, factor: Column, adm_factor, occ_factor,
             lo, hi, k, group_cols=()) -> DataFrame:
    """Calendar-scaled admissions, admission-correlated occupancy clipped to
    [lo, hi] (1 decimal), then the interval overlay on both. ``factor``, the uplifts,
    the bounds and ``k`` (occupancy per standard deviation of admissions) are numbers or columns of ``series``."""
    s = calendar_scale(series, factor)
    s = zscore(s, "scenarioAdmissions", 1.0, group_cols, "_z")
    s = s.withColumn("scenarioOccupancy", C.clip_round(F.col(S.OCCUPANCY) + F.col("_z") * F.lit(k), lo, hi, 1)).drop("_z")
    return interval_uplift(s, intervals, adm_factor, occ_factor, hi, group_cols, admissions="scenarioAdmissions", occupancy="scenarioOccupancy")
