"""Joins on series keys in which a null key is a series like any other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_series(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """Equi-join on ``keys``, null equal to null; ``right``'s keys are not repeated."""
    keys = list(keys)
    named = {k: f"__right_{i}" for i, k in enumerate(keys)}
    other = right.select(*[F.col(k).alias(named[k]) for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[named[k]]) for k in keys])
    return left.join(other, on, how).drop(*named.values())
