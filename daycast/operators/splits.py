"""Time-ordered and seeded splits.

They rank daily rows within each series (one window partition per series,
bounded by its number of days) and label rows instead of materialising copies:
a fold is two filters on one cached, labelled table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast import schema as S
from daycast.operators.daily import series_window
from daycast.operators.keys import join_series


def _ranked(df: DataFrame, group_cols, order_col: str, common: bool) -> DataFrame:
    """``df`` with _rn (0-based) and _n: place and number of rows of the series, or,
    with ``common``, place and number of distinct dates over all series."""
    if not common:
        return df.withColumns({
            "_rn": F.row_number().over(series_window(group_cols, order_col)) - 1,
            "_n": F.count(F.lit(1)).over(Window.partitionBy(*group_cols)),
        })
    # One row per calendar day: the only table a keyless window sees.
    days = df.select(order_col).distinct()
    days = days.withColumns({"_rn": F.row_number().over(Window.orderBy(order_col)) - 1, "_n": F.count(F.lit(1)).over(Window.partitionBy())})
    return join_series(df, days, [order_col])


def split_by_time(df: DataFrame, test_size: float = 0.2, group_cols=(), order_col: str = S.DATE,
                  label: str = "split", common: bool = False) -> DataFrame:
    """The first int(n * (1 - test_size)) days are ``train``, the rest ``test``.

    Days are those of each series; with ``common``, those of all series together,
    so that one date cuts every series and a model fitted on all of them never
    sees a day that another series is tested on.
    """
    ranked = _ranked(df, group_cols, order_col, common)
    cut = F.floor(F.col("_n").cast("double") * F.lit(1.0 - test_size))
    return ranked.withColumn(label, F.when(F.col("_rn") < cut, F.lit("train")).otherwise(F.lit("test"))).drop("_rn", "_n")


def train_test(df: DataFrame, test_size: float = 0.2, group_cols=(), order_col: str = S.DATE, common: bool = False):
    labelled = split_by_time(df, test_size, group_cols, order_col, "_split", common)
    train = labelled.where(F.col("_split") == "train").drop("_split")
    test = labelled.where(F.col("_split") == "test").drop("_split")
    return train, test


def time_series_folds(df: DataFrame, n_splits: int = 5, group_cols=(), order_col: str = S.DATE,
                      label: str = "test_fold", common: bool = False) -> DataFrame:
    """Expanding-window folds, labelled in one column.

    With n days and s = n // (k + 1), fold i (0-based) tests days
    [n - (k - i) s, n - (k - i - 1) s) and trains on every earlier one. Each
    row gets the fold that tests it (-1 for rows only ever used to train), so
    fold i = (``label`` < i) for training and (``label`` == i) for testing.
    ``common`` counts the days of all series together, as in ``split_by_time``.
    Fewer than k + 1 days are an error when the rows are computed.
    """
    k = int(n_splits)
    ranked = _ranked(df, group_cols, order_col, common)
    n, rn = F.col("_n"), F.col("_rn")
    s = F.floor(n / F.lit(k + 1))
    start = n - F.lit(k) * s
    fold = F.when(s == 0, F.raise_error(F.lit(f"{k} folds need at least {k + 1} days")).cast("int")) \
            .when(rn >= start, F.floor((rn - start) / s)).otherwise(F.lit(-1))
    return ranked.withColumns({"_row": rn, label: fold.cast("int")}).drop("_rn", "_n")


def fold_frames(labelled: DataFrame, fold: int, label: str = "test_fold"):
    """(train, test) of fold ``fold`` from :func:`time_series_folds` output."""
    train = labelled.where(F.col(label) < fold)
    test = labelled.where(F.col(label) == fold)
    return train, test


def random_split(df: DataFrame, test_size: float = 0.2, seed: int = 42, key_cols=(S.DATE,), group_cols=(),
                 label: str = "split") -> DataFrame:
    """M5: seeded shuffle split; ceil(test_size * n) rows per series go to ``test``.

    Rows are ranked by md5 of seed and keys, which does not depend on how the
    data is partitioned (unlike ``randomSplit``) and is the same in any engine.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    w = Window.partitionBy(*group_cols).orderBy(F.md5(text.cast("binary")), *[F.col(c) for c in key_cols])
    rn = F.row_number().over(w)
    n = F.count(F.lit(1)).over(Window.partitionBy(*group_cols))
    n_test = F.ceil(n.cast("double") * F.lit(float(test_size)))
    return df.withColumn(label, F.when(rn <= n_test, F.lit("test")).otherwise(F.lit("train")))
