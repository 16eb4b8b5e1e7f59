"""Threshold alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast import schema as S
from daycast.functions import columns as C


@dataclass(frozen=True)
class AlertRule:
    kind: str          # alert type label, e.g. "admissions"
    value_col: str     # predicted (or observed) value
    threshold: object  # float or column name / Column
    template: str      # printf-style message with one %.1f
    flag_col: str      # boolean output column of flag_alerts


def default_rules(admission_threshold, occupancy_threshold=S.OCCUPANCY_THRESHOLD,
                  admissions_col: str = "predicted_admissions",
                  occupancy_col: str = "predicted_occupancy") -> list[AlertRule]:
    return [
        AlertRule("admissions", admissions_col, admission_threshold, S.ADMISSION_ALERT_MESSAGE, "admission_alert"),
        AlertRule("occupancy", occupancy_col, occupancy_threshold, S.OCCUPANCY_ALERT_MESSAGE, "occupancy_alert"),
    ]


def _thr(t) -> Column:
    if isinstance(t, Column):
        return t.cast("double")
    if isinstance(t, str):
        return F.col(t).cast("double")
    return F.lit(None).cast("double") if t is None else F.lit(float(t))


def flag_alerts(df: DataFrame, rules: list[AlertRule]) -> DataFrame:
    """One boolean per rule: value >= threshold."""
    return df.withColumns({r.flag_col: F.coalesce(F.col(r.value_col) >= _thr(r.threshold), F.lit(False))
                           for r in rules})


def alert_rows(df: DataFrame, rules: list[AlertRule], date_col: str = S.DATE, group_cols=()) -> DataFrame:
    """One row per exceeded rule: date (yyyy-MM-dd), type, value, threshold, message."""
    entries = [
        F.when(
            F.col(r.value_col) >= _thr(r.threshold),
            F.struct(
                F.lit(r.kind).alias("type"),
                F.col(r.value_col).cast("double").alias("predicted_value"),
                _thr(r.threshold).alias("threshold"),
                C.alert_message(r.template, F.col(r.value_col)).alias("message"),
            ),
        )
        for r in rules
    ]
    hits = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return df.select(
        *group_cols,
        F.date_format(F.col(date_col), "yyyy-MM-dd").alias(date_col),
        F.explode(hits).alias("_a"),
    ).select(*group_cols, date_col, "_a.*")
