"""Visit preparation, schema checks and imputation."""

from __future__ import annotations

import logging
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from daycast import schema as S
from daycast.functions import columns as C
from daycast.operators.keys import join_series
from daycast.operators.quantiles import modes_of, quantiles_of, sketches
from daycast.session import local_frame, materialize

log = logging.getLogger(__name__)


def require_columns(df: DataFrame, cols, strict: bool = True) -> list[str]:
    """Missing columns of ``df``: raise when ``strict``, else log and return them."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        msg = f"missing columns: {', '.join(missing)}"
        if strict:
            raise ValueError(msg)
        log.warning(msg)
    return missing


def enrich_visits(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Derived numerics, flags and calendar columns of raw visits (F1 -> F2).

    A column is derived only when its source column exists.
    """
    v = {**S.VISIT_COLUMNS, **(names or {})}
    require_columns(df, [v["patient"], v["arrival"], v["departure"], v["waiting"], v["occupancy"]], strict=False)
    have = set(df.columns)
    new = {}
    if v["waiting"] in have:
        new["waitingHours"] = C.first_number(v["waiting"])
    if v["arrival"] in have and v["departure"] in have:
        new["stayDuration"] = C.duration_days(v["arrival"], v["departure"])
    if v["occupancy"] in have:
        new["occupancyRate"] = C.parse_percent(v["occupancy"])
    if v["admission_type"] in have:
        new["isEmergency"] = C.equals_flag(v["admission_type"], S.EMERGENCY_LABEL)
    if v["icu"] in have:
        new["needsICU"] = C.equals_flag(v["icu"], S.YES_LABEL)
    if v["bed"] in have:
        new["hasBed"] = C.equals_flag(v["bed"], S.YES_LABEL)
    if v["arrival"] in have:
        new.update(
            C.calendar_columns(
                v["arrival"],
                {
                    "month": "arrivalMonth",
                    "dayOfMonth": "arrivalDay",
                    "dayOfWeek": "arrivalDayOfWeek",
                    "year": "arrivalYear",
                },
            )
        )
    return df.withColumns(new)


IMPUTED_VISIT_COLUMNS = ("waitingHours", "stayDuration", "occupancyRate")


def prepare_visits(df: DataFrame, names: dict[str, str] | None = None, impute: bool = True,
                   approx: bool = False, group_cols=()) -> DataFrame:
    """Enrich visits and fill missing derived measures with their series' median.

    Ids and calendar parts are never imputed; only the derived measures are.
    """
    out = enrich_visits(df, names)
    if impute:
        cols = [c for c in IMPUTED_VISIT_COLUMNS if c in out.columns]
        out = impute_median(out, cols, approx=approx, group_cols=group_cols)
    return out


def columns_with_nulls(df: DataFrame, cols) -> list[str]:
    """Those of ``cols`` that hold a null (one pass)."""
    cols = list(cols)
    if not cols:
        return []
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def column_medians(df: DataFrame, cols, approx: bool = False, accuracy: int = 10_000, group_cols=(), sketch=None) -> DataFrame | None:
    """Medians of ``cols`` per series, one row per series (``group_cols`` and one column each).

    Exact medians interpolate linearly; ``approx=True`` takes the sketch's value.
    All columns share the passes of ``quantiles.quantiles_of``.
    """
    g, cols = list(group_cols), list(cols)
    if not cols:
        return None
    if approx:
        return df.groupBy(*g).agg(*[F.percentile_approx(c, 0.5, accuracy).cast("double").alias(c) for c in cols])
    found = quantiles_of(df, cols, [0.5], g, accuracy, sketch)
    if not g:
        medians = {r["col"]: r["q"][0] for r in found.collect()}
        return local_frame(df.sparkSession, dict.fromkeys(cols, "double"), [[medians[c] for c in cols]])
    return found.groupBy(*g).agg(*[F.max(F.when(F.col("col") == c, F.col("q")[0])).alias(c) for c in cols])


def _filled(df: DataFrame, cols, fills: DataFrame, group_cols) -> DataFrame:
    """Nulls of ``cols`` replaced by the series' values in ``fills``."""
    g = list(group_cols)
    if not g:
        row = fills.first()
        if row is None:
            return df
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(row[c]).cast(df.schema[c].dataType)) for c in cols if row[c] is not None})
    named = fills.select(*g, *[F.col(c).alias(f"__fill_{c}") for c in cols])
    out = join_series(df, named, g)
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"__fill_{c}").cast(df.schema[c].dataType)) for c in cols}).select(*df.columns)


@contextmanager
def held(df: DataFrame):
    """``df`` cached while statistics that take several passes are made of it.

    Cache a narrow selection: the source is then read once, whatever the number of
    passes. Partitions of a lost executor are computed again.
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def _kept(fills: DataFrame, group_cols) -> DataFrame:
    """Small statistics made final while their source is cached: a written table, or without series keys a local row."""
    if group_cols:
        return materialize(fills, "fills")
    return fills.sparkSession.createDataFrame(fills.toArrow())


def impute_median(df: DataFrame, cols, approx: bool = False, accuracy: int = 10_000, group_cols=()) -> DataFrame:
    """P10: nulls of numeric ``cols`` take the column's median of the same series.

    ``df`` is read once for the statistics, whatever the number of columns: the
    keys and ``cols`` are cached, sketched together with their null counts, and
    only columns with a null are ranked. A series without any value keeps its nulls.
    """
    g, cols = list(group_cols), list(cols)
    if not cols:
        return df
    with held(df.select(*dict.fromkeys([*g, *cols]))) as narrow:
        if approx:
            need = columns_with_nulls(narrow, cols)
            if not need:
                return df
            fills = _kept(column_medians(narrow, need, True, accuracy, g), g)
        else:
            sketch = sketches(narrow, cols, [0.5], g, accuracy)
            if g:
                sketch = materialize(sketch, "sketch")
                nulls = sketch.agg(*[F.sum(F.col(f"_k{i}")["nulls"]) for i in range(len(cols))]).first()
            else:
                sketch = sketch.first()
                nulls = [k["nulls"] for k in sketch]
            places = [i for i in range(len(cols)) if nulls[i]]
            need = [cols[i] for i in places]
            if not need:
                return df
            sketch = sketch.select(*g, *[F.col(f"_k{i}").alias(f"_k{j}") for j, i in enumerate(places)]) if g else [sketch[i] for i in places]
            fills = _kept(column_medians(narrow, need, False, accuracy, g, sketch), g)
    return _filled(df, need, fills, g)


def impute_mode(df: DataFrame, cols, group_cols=()) -> DataFrame:
    """Nulls take the most frequent value of the same series; the smallest one on ties.

    ``df`` is read once: the keys and ``cols`` are cached, and the columns with a
    null are counted by value together.
    """
    g, cols = list(group_cols), list(cols)
    if not cols:
        return df
    with held(df.select(*dict.fromkeys([*g, *cols]))) as narrow:
        need = columns_with_nulls(narrow, cols)
        if not need:
            return df
        fills = _kept(modes_of(narrow, need, g), g)
    return _filled(df, need, fills, g)


def impute_by_type(df: DataFrame, exclude=(S.DATE,), approx: bool = False, group_cols=()) -> DataFrame:
    """Numeric columns -> median, other columns -> mode (E3's imputation), per series.

    Series keys, the date and the calendar columns are never imputed.
    """
    skip = {*exclude, *group_cols, *S.CALENDAR_COLUMNS, *S.FLAG_COLUMNS}
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in skip]
    other = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in skip]
    return impute_mode(impute_median(df, numeric, approx=approx, group_cols=group_cols), other, group_cols)


def cast_int(df: DataFrame, cols=("month", "dayOfWeek")) -> DataFrame:
    """Cast the given columns (if present) to int."""
    return df.withColumns({c: F.col(c).cast("int") for c in cols if c in df.columns})


def default_missing_columns(df: DataFrame, features, mode: str = "entry") -> DataFrame:
    """Add absent feature columns with the forecasting defaults.

    ``mode='entry'`` (a single forecast row): calendar parts -> 1, ``is*`` -> 0,
    names containing ``occupancy`` -> 75, anything else -> 80.
    ``mode='history'`` (a history table): absent targets -> 75 / 50; calendar
    parts and flags come from the date, where there is one; other absent
    features -> 0. ``mode='lags'``: an absent lag copies its target, other
    features are left alone.
    """
    new = {}
    if mode == "lags":
        for f in features:
            target = S.LAG_TARGETS.get(f)
            if f not in df.columns and target in df.columns:
                new[f] = F.col(target)
    elif mode == "history":
        if S.OCCUPANCY not in df.columns:
            new[S.OCCUPANCY] = F.lit(S.DEFAULT_HISTORY_OCCUPANCY)
        if S.ADMISSIONS not in df.columns:
            new[S.ADMISSIONS] = F.lit(S.DEFAULT_HISTORY_ADMISSIONS)
        calendar = C.calendar_columns(S.DATE) if S.DATE in df.columns else {}
        for f in features:
            if f not in df.columns and f not in new:
                new[f] = calendar.get(f, F.lit(0.0))
    else:
        for f in features:
            if f not in df.columns:
                new[f] = F.lit(entry_default(f))
    return df.withColumns(new) if new else df


def entry_default(feature: str) -> float:
    if feature in S.CALENDAR_COLUMNS:
        return float(S.DEFAULT_CALENDAR_VALUE)
    if feature.startswith("is"):
        return float(S.DEFAULT_FLAG_VALUE)
    if "occupancy" in feature:
        return S.DEFAULT_OCCUPANCY_VALUE
    return S.DEFAULT_OTHER_VALUE


def visit_quality(visits: DataFrame, names: dict[str, str] | None = None, group_cols=()) -> DataFrame:
    """Per series: visits, and how many have no arrival day (they are in no daily row) or a
    waiting time or occupancy text without a number (they count as missing). One pass."""
    v = {**S.VISIT_COLUMNS, **(names or {})}
    junk = lambda source, parsed: F.count_if(F.col(source).isNotNull() & parsed.isNull())
    aggs = [F.count(F.lit(1)).alias("visits"), F.count_if(F.to_date(F.col(v["arrival"])).isNull()).alias("undated")]
    if v["waiting"] in visits.columns:
        aggs.append(junk(v["waiting"], C.first_number(v["waiting"])).alias("junk_waiting"))
    if v["occupancy"] in visits.columns:
        aggs.append(junk(v["occupancy"], C.parse_percent(v["occupancy"])).alias("junk_occupancy"))
    return visits.groupBy(*group_cols).agg(*aggs)


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """A3: one row, one bigint per column: its number of nulls (one pass)."""
    cols = list(cols) if cols is not None else df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])


def date_bounds(df: DataFrame, date_col: str = S.DATE, group_cols=()) -> DataFrame:
    """A2: first day, last day and number of distinct days (per series)."""
    d = F.to_date(F.col(date_col))
    return df.groupBy(*group_cols).agg(
        F.min(d).alias("min_date"),
        F.max(d).alias("max_date"),
        F.count_distinct(d).cast("bigint").alias("n_days"),
    )


def select_features(df: DataFrame, targets=S.TARGETS, exclude=(S.DATE,), group_cols=()) -> list[str]:
    """Every column except targets, excluded names and the series keys."""
    skip = set(targets) | set(exclude) | set(group_cols)
    return [c for c in df.columns if c not in skip]
