"""Scalar column expressions (all JVM-side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daycast import schema as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_number(c) -> Column:
    """First run of digits in a text, as double; null when there is none."""
    return F.regexp_substr(_c(c).cast("string"), F.lit(r"\d+")).try_cast("double")


def duration_days(start, end) -> Column:
    """(end - start) in days, as double; negative when end precedes start."""
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return micros.cast("double") / F.lit(86_400_000_000.0)


def parse_percent(c) -> Column:
    """Percent text such as ``75%`` or ``75,5 %`` to a number; junk becomes null (``prepare.visit_quality`` counts it)."""
    text = F.rtrim(F.trim(F.rtrim(F.trim(_c(c).cast("string")), F.lit("%"))))
    return F.regexp_replace(text, r"^([+-]?\d*),(\d+)$", "$1.$2").try_cast("double")


def equals_flag(c, value) -> Column:
    """1 when equal to ``value``, else 0 (null counts as not equal)."""
    return _c(c).eqNullSafe(F.lit(value)).cast("int")


def parse_timestamp(c, formats=()) -> Column:
    """Text or timestamp to timestamp: ISO text first, then ``formats`` in order; unparseable values become null."""
    text = _c(c).cast("string")
    return F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def day_of_week(c) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(c))


def is_weekend(c) -> Column:
    return (F.weekday(_c(c)) >= 5).cast("int")


def season_flags(month) -> dict[str, Column]:
    m = _c(month)
    return {
        "isSummer": m.isin(*S.SUMMER_MONTHS).cast("int"),
        "isWinter": m.isin(*S.WINTER_MONTHS).cast("int"),
        "isSpring": m.isin(*S.SPRING_MONTHS).cast("int"),
        "isFall": m.isin(*S.FALL_MONTHS).cast("int"),
    }


def season_label(month) -> Column:
    m = _c(month)
    expr = None
    for label, months in S.SEASON_MONTHS.items():
        cond = m.isin(*months)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def calendar_columns(date, names: dict[str, str] | None = None) -> dict[str, Column]:
    """Calendar parts and flags of a date/timestamp column.

    ``names`` renames the outputs; keys are month, dayOfMonth, dayOfWeek, year,
    isWeekend, isSummer, isWinter, isSpring, isFall.
    """
    d = _c(date)
    month = F.month(d)
    cols = {
        "month": month,
        "dayOfMonth": F.dayofmonth(d),
        "dayOfWeek": F.weekday(d),
        "year": F.year(d),
        "isWeekend": is_weekend(d),
        **season_flags(month),
    }
    names = names or {}
    return {names.get(k, k): v for k, v in cols.items() if names.get(k, k) is not None}


def round_half_even(c, decimals: int = 0) -> Column:
    """Round like NumPy: ``rint(x * 10^d) / 10^d`` (ties to even on the scaled binary value)."""
    if decimals == 0:
        return F.rint(_c(c))
    scale = float(10**decimals)
    return F.rint(_c(c) * F.lit(scale)) / F.lit(scale)


def clip(c, lo=None, hi=None) -> Column:
    out = _c(c)
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(float(hi)))
    return out


def clip_round(c, lo, hi, decimals: int = 1) -> Column:
    return round_half_even(clip(c, lo, hi), decimals)


def calendar_factor(date, month_factors: dict, weekday_factors: dict) -> Column:
    """Product of a month's and a weekday's (Monday = 0) multiplier; 1 where none is given."""
    out = F.lit(1.0)
    for part, factors in ((F.month(_c(date)), month_factors), (F.weekday(_c(date)), weekday_factors)):
        one = None
        for key, value in factors.items():
            one = F.when(part == key, F.lit(float(value))) if one is None else one.when(part == key, F.lit(float(value)))
        out = out * (one.otherwise(F.lit(1.0)) if one is not None else F.lit(1.0))
    return out


def format_fixed(value, decimals: int = 1) -> Column:
    """Fixed-point text rounded on the exact binary value, ties to even (like
    Python's and C's ``%.Nf``); no grouping separators."""
    return F.regexp_replace(F.format_number(_c(value).cast("double"), decimals), ",", "")


def alert_message(template: str, value) -> Column:
    """``template`` holds one ``%.1f``; the number is formatted by :func:`format_fixed`."""
    return F.format_string(template.replace("%.1f", "%s"), format_fixed(value, 1))
