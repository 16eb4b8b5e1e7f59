"""Daily series: aggregation, gap filling and window features.

Every window here is ``partitionBy(*group_cols).orderBy(date)`` over a
*daily* table, so a window partition holds one row per day of one series:
its size is bounded by the calendar, never by the number of raw records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daycast import schema as S
from daycast.functions import columns as C
from daycast.operators.keys import join_series
from daycast.operators.prepare import column_medians, enrich_visits, held, require_columns
from daycast.session import materialize

V = S.VISIT_COLUMNS


def series_window(group_cols=(), order_col: str = S.DATE, descending: bool = False):
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    return Window.partitionBy(*group_cols).orderBy(order)


MEASURES = (("occupancyRate", S.OCCUPANCY), ("waitingHours", "waitingHours"), ("stayDuration", "stayDuration"))


def aggregate_daily(visits: DataFrame, group_cols=(), names: dict[str, str] | None = None,
                    impute: bool = False, approx: bool = False) -> DataFrame:
    """A1: one row per (series, arrival day) from enriched visits.

    totalAdmissions counts non-null patients; emergency and ICU flags are
    summed; occupancy, waiting time and stay are averaged. Calendar columns are
    recomputed from the day (they are constant per day). Visits without an
    arrival day are in no row; ``prepare.visit_quality`` counts them.

    ``impute=True`` gives the daily means of the measures with missing values
    replaced by the series' median (E1's imputation). The visits are read once:
    their day, keys and measures are cached while the aggregate and the medians
    are made. The aggregate keeps per-day sums, counts and null counts, the
    medians are computed only for columns that have nulls, and each day's mean
    becomes (sum + nulls * median) / (count + nulls). The aggregate (days x
    series rows) is written to the shared folder once, since every later step reads it.
    """
    v = {**V, **(names or {})}
    require_columns(visits, [v["patient"], v["arrival"]], strict=True)
    day = F.to_date(F.col(v["arrival"]))
    have = set(visits.columns)
    aggs = [F.count(F.col(v["patient"])).cast("double").alias(S.ADMISSIONS)]
    for flag in ("isEmergency", "needsICU"):
        if flag in have:
            aggs.append(F.sum(flag).cast("bigint").alias(flag))
    measures = [(src, out) for src, out in MEASURES if src in have]
    for src, out in measures:
        if impute:
            aggs += [F.sum(src).alias(f"_s_{out}"), F.count(src).alias(f"_c_{out}"),
                     F.count_if(F.col(src).isNull()).alias(f"_k_{out}")]
        else:
            aggs.append(F.avg(src).alias(out))
    if not (impute and measures):
        daily = visits.where(day.isNotNull()).groupBy(*group_cols, day.alias(S.DATE)).agg(*aggs)
        return daily.withColumns(C.calendar_columns(S.DATE))
    used = [v["patient"], *[f for f in ("isEmergency", "needsICU") if f in have], *[src for src, _ in measures]]
    with held(visits.select(*group_cols, day.alias("_day"), *[c for c in dict.fromkeys(used) if c not in group_cols])) as narrow:
        daily = materialize(narrow.where(F.col("_day").isNotNull()).groupBy(*group_cols, F.col("_day").alias(S.DATE)).agg(*aggs), "daily")
        nulls = daily.agg(*[F.sum(f"_k_{out}").alias(out) for _, out in measures]).first()
        need = [src for src, out in measures if (nulls[out] or 0) > 0]
        if need:
            medians = column_medians(narrow, need, approx, group_cols=group_cols)
            named = medians.select(*group_cols, *[F.col(c).alias(f"_m_{c}") for c in need])
            if group_cols:
                daily = join_series(daily, materialize(named, "medians"), group_cols)
            else:
                row = named.first()
                daily = daily.withColumns({c: F.lit(row[c]).cast("double") for c in named.columns})
    means = {}
    for src, out in measures:
        s_, c_, k_ = F.coalesce(F.col(f"_s_{out}"), F.lit(0.0)), F.col(f"_c_{out}").cast("double"), F.col(f"_k_{out}").cast("double")
        plain = F.when(c_ > 0, s_ / c_)
        if src in need:
            m = F.col(f"_m_{src}")
            means[out] = F.when(m.isNotNull() & (c_ + k_ > 0), (s_ + k_ * m) / (c_ + k_)).otherwise(plain)
        else:
            means[out] = plain
    daily = daily.withColumns(means).drop(*[f"_m_{c}" for c in need], *[f"_{p}_{out}" for _, out in measures for p in "sck"])
    return daily.withColumns(C.calendar_columns(S.DATE))


def day_spine(daily: DataFrame, group_cols=(), date_col: str = S.DATE) -> DataFrame:
    """Every day from the first to the last day of each series."""
    bounds = daily.groupBy(*group_cols).agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    return bounds.select(
        *group_cols,
        F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.expr("INTERVAL 1 DAY"))).alias(date_col),
    )


def densify_daily(daily: DataFrame, group_cols=(), count_cols=S.COUNT_COLUMNS,
                  date_col: str = S.DATE) -> DataFrame:
    """J1 + W6: a gap-free daily series per group.

    The day spine is left-joined with the daily aggregate; count columns are 0
    on gap days, measures stay null (see :func:`forward_fill`) and calendar
    columns are recomputed from the spine day.
    """
    calendar = set(C.calendar_columns(date_col))
    measures = daily.drop(*[c for c in daily.columns if c in calendar])
    dense = join_series(day_spine(daily, group_cols, date_col), measures, [*group_cols, date_col])
    return fill_zero(dense, count_cols).withColumns(C.calendar_columns(date_col))


def fill_zero(df: DataFrame, cols=S.COUNT_COLUMNS) -> DataFrame:
    """Nulls of count columns -> 0."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType))
                           for c in cols if c in df.columns})


def forward_fill(df: DataFrame, cols=S.FFILL_COLUMNS, group_cols=(), order_col: str = S.DATE) -> DataFrame:
    """The last non-null value up to the current day (running frame, O(n))."""
    w = series_window(group_cols, order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols if c in df.columns})


def backward_fill(df: DataFrame, cols=S.FFILL_COLUMNS, group_cols=(), order_col: str = S.DATE) -> DataFrame:
    """The first non-null value from the current day on.

    Computed as a running frame in descending order, which costs one sort
    instead of re-aggregating an unbounded-following frame per row.
    """
    w = series_window(group_cols, order_col, descending=True).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols if c in df.columns})


def lag_zero(c: str, n: int, group_cols=(), order_col: str = S.DATE) -> Column:
    """Value ``n`` days before; the first ``n`` days get 0."""
    return F.coalesce(F.lag(c, n).over(series_window(group_cols, order_col)), F.lit(0.0))


def lag(c: str, n: int, group_cols=(), order_col: str = S.DATE) -> Column:
    return F.lag(c, n).over(series_window(group_cols, order_col))


def rolling_mean(c: str, window: int = S.MA_WINDOW, group_cols=(), order_col: str = S.DATE,
                 include_current: bool = True) -> Column:
    """Mean of the non-null values of the last ``window`` rows.

    ``include_current=False`` uses the ``window`` rows before the current one.
    """
    w = series_window(group_cols, order_col)
    frame = w.rowsBetween(-(window - 1), 0) if include_current else w.rowsBetween(-window, -1)
    return F.avg(c).over(frame)


def add_lag_features(daily: DataFrame, group_cols=(), admissions: str = S.ADMISSIONS,
                     occupancy: str = S.OCCUPANCY, lags=S.LAGS, window: int = S.MA_WINDOW) -> DataFrame:
    """W1-W3 (+W2's backfill): lag and moving-average columns of both targets.

    admissionsLagN: leading days -> 0. occupancyLagN: leading days take the
    next non-null lagged value. *MA7 includes the current day; *MA7Prev uses
    the seven days before it (admissions -> 0, occupancy backfilled on day one).
    All ascending-order windows share one sort; the backfill adds one more.
    """
    new = {f"admissionsLag{n}": lag_zero(admissions, n, group_cols) for n in lags}
    new.update({f"occupancyLag{n}": lag(occupancy, n, group_cols) for n in lags})
    new["admissionsMA7"] = rolling_mean(admissions, window, group_cols)
    new["occupancyMA7"] = rolling_mean(occupancy, window, group_cols)
    new["admissionsMA7Prev"] = F.coalesce(
        rolling_mean(admissions, window, group_cols, include_current=False), F.lit(0.0))
    new["occupancyMA7Prev"] = rolling_mean(occupancy, window, group_cols, include_current=False)
    out = daily.withColumns(new)
    return backward_fill(out, [f"occupancyLag{n}" for n in lags] + ["occupancyMA7Prev"], group_cols)


def build_daily_features(visits: DataFrame, group_cols=(), names: dict[str, str] | None = None,
                         impute: bool = True, approx: bool = False) -> DataFrame:
    """Raw visits -> gap-free daily series with calendar, lag and MA features.

    One pass over the visits: one shuffle by (series, day) for the aggregate
    (partial aggregation on the map side; medians only when values are
    missing), one small join with the day spine, then window sorts on the
    cached daily rows only.
    """
    daily = aggregate_daily(enrich_visits(visits, names), group_cols, names, impute=impute, approx=approx)
    dense = forward_fill(densify_daily(daily, group_cols), S.FFILL_COLUMNS, group_cols)
    return add_lag_features(dense, group_cols)


def distinct_days(visits: DataFrame, names: dict[str, str] | None = None, group_cols=()) -> DataFrame:
    """The distinct arrival days (per series)."""
    v = {**V, **(names or {})}
    day = F.to_date(F.col(v["arrival"]))
    return visits.where(day.isNotNull()).select(*group_cols, day.alias(S.DATE)).distinct()


def tail_by_date(df: DataFrame, n: int = 50, group_cols=(), order_col: str = S.DATE) -> DataFrame:
    """The last ``n`` days of each series."""
    rn = F.row_number().over(series_window(group_cols, order_col, descending=True))
    return df.withColumn("_rn", rn).where(F.col("_rn") <= n).drop("_rn")


def sort_by_date(df: DataFrame, group_cols=(), order_col: str = S.DATE) -> DataFrame:
    """Output ordering only."""
    return df.orderBy(*group_cols, order_col)
