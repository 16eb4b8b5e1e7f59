"""Seasonality profiles of a daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast import schema as S
from daycast.functions.columns import season_label
from daycast.operators.prepare import require_columns


def _stats(adm: str, occ: str, with_count: bool) -> list:
    out = [
        F.avg(adm).alias("admissions_mean"),
        F.stddev_samp(adm).alias("admissions_std"),
        F.max(adm).alias("admissions_max"),
    ]
    if with_count:
        out.append(F.count(adm).cast("bigint").alias("admissions_count"))
    out += [
        F.avg(occ).alias("occupancy_mean"),
        F.stddev_samp(occ).alias("occupancy_std"),
        F.max(occ).alias("occupancy_max"),
    ]
    return out


def monthly_pattern(df: DataFrame, adm: str = S.ADMISSIONS, occ: str = S.OCCUPANCY, group_cols=()) -> DataFrame:
    """A4: mean, sample std and max of both targets per month."""
    require_columns(df, ["month", adm, occ])
    return df.groupBy(*group_cols, F.col("month").cast("int").alias("month")).agg(*_stats(adm, occ, False))


def weekly_pattern(df: DataFrame, adm: str = S.ADMISSIONS, occ: str = S.OCCUPANCY, group_cols=()) -> DataFrame:
    """A5: the same per weekday (Monday = 0)."""
    require_columns(df, ["dayOfWeek", adm, occ])
    return df.groupBy(*group_cols, F.col("dayOfWeek").cast("int").alias("dayOfWeek")).agg(*_stats(adm, occ, False))


def seasonal_pattern(df: DataFrame, adm: str = S.ADMISSIONS, occ: str = S.OCCUPANCY, group_cols=()) -> DataFrame:
    """The same per season label, plus the number of days."""
    require_columns(df, ["month", adm, occ])
    return df.groupBy(*group_cols, season_label("month").alias("season")).agg(*_stats(adm, occ, True))


def weekend_pattern(df: DataFrame, adm: str = S.ADMISSIONS, occ: str = S.OCCUPANCY, group_cols=()) -> DataFrame:
    """Weekend vs weekday, plus the number of days."""
    require_columns(df, ["dayOfWeek", adm, occ])
    return df.groupBy(*group_cols, (F.col("dayOfWeek") >= 5).alias("is_weekend")).agg(*_stats(adm, occ, True))


def seasonal_patterns(df: DataFrame, adm: str = S.ADMISSIONS, occ: str = S.OCCUPANCY, group_cols=()) -> dict[str, DataFrame]:
    """All four profiles."""
    return {
        "monthly": monthly_pattern(df, adm, occ, group_cols),
        "weekly": weekly_pattern(df, adm, occ, group_cols),
        "seasonal": seasonal_pattern(df, adm, occ, group_cols),
        "weekend": weekend_pattern(df, adm, occ, group_cols),
    }
