"""Thresholds, accuracy metrics and residual distributions.

Every metric is one aggregation pass (partial aggregation on the map side),
returned in long form ``(group..., target, metric, value)``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast import schema as S
from daycast.operators.keys import join_series
from daycast.operators.quantiles import exact_quantiles

EPS = 2.220446049250313e-16  # float64 machine epsilon, floor for |y| in MAPE

BASIC = ("mse", "rmse", "mae", "r2")
EXTENDED = ("mae", "mse", "rmse", "r2", "mape", "explained_variance")


def iqr_threshold(df: DataFrame, col: str = S.ADMISSIONS, k: float = S.IQR_FACTOR, group_cols=(),
                  approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    """q25, q75 (linear interpolation) and q75 + k * (q75 - q25), per series."""
    if approx:
        out = df.groupBy(*group_cols).agg(F.percentile_approx(col, [0.25, 0.75], accuracy).alias("q"))
    else:
        out = exact_quantiles(df, col, [0.25, 0.75], group_cols, accuracy)
    q25, q75 = F.col("q")[0].cast("double"), F.col("q")[1].cast("double")
    return out.select(
        *group_cols,
        q25.alias("q25"),
        q75.alias("q75"),
        (q75 + F.lit(float(k)) * (q75 - q25)).alias("threshold"),
    )


def residuals(df: DataFrame, y: str, yhat: str, out: str = "residual"):
    """Y - yhat."""
    return df.withColumn(out, F.col(y) - F.col(yhat))


def _target_aggs(t: str, y: str, yhat: str, extended: bool) -> list:
    valid = F.col(y).isNotNull() & F.col(yhat).isNotNull()
    yv = F.when(valid, F.col(y))
    e = F.when(valid, F.col(y) - F.col(yhat))
    aggs = [
        F.count_if(valid).alias(f"{t}__n"),
        F.sum(e * e).alias(f"{t}__sse"),
        F.sum(F.abs(e)).alias(f"{t}__sae"),
        F.var_pop(yv).alias(f"{t}__vy"),
    ]
    if extended:
        aggs += [
            # mean(|e| / max(|y|, eps)); the |y| < eps terms (exact: eps is a power
            # of two) are summed apart from the ordinary ones, so the result does
            # not depend on summation order when a target is zero.
            F.try_divide(
                F.coalesce(F.sum(F.when(F.abs(yv) < F.lit(EPS), F.abs(e) / F.lit(EPS))), F.lit(0.0))
                + F.coalesce(F.sum(F.when(F.abs(yv) >= F.lit(EPS), F.abs(e) / F.abs(yv))), F.lit(0.0)),
                F.count_if(valid).cast("double"),
            ).alias(f"{t}__mape"),
            F.var_pop(e).alias(f"{t}__ve"),
        ]
    return aggs


def _target_metrics(t: str, extended: bool) -> dict:
    n = F.col(f"{t}__n").cast("double")
    sse, sae, vy = F.col(f"{t}__sse"), F.col(f"{t}__sae"), F.col(f"{t}__vy")
    sst = vy * n
    mse = F.try_divide(sse, n)
    m = {
        "mse": mse,
        "rmse": F.sqrt(mse),
        "mae": F.try_divide(sae, n),
        # Constant targets: 1.0 for a perfect fit, 0.0 otherwise.
        "r2": F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(1 - F.try_divide(sse, sst)),
    }
    if extended:
        ve = F.col(f"{t}__ve")
        m["mape"] = F.col(f"{t}__mape")
        m["explained_variance"] = F.when(
            vy == 0, F.when(ve == 0, F.lit(1.0)).otherwise(F.lit(0.0))
        ).otherwise(1 - F.try_divide(ve, vy))
    return m


def regression_metrics(df: DataFrame, pairs: dict[str, tuple[str, str]], group_cols=(),
                       extended: bool = False) -> DataFrame:
    """A9 (and A10 with ``extended``): metrics per target in one pass.

    ``pairs`` maps a target label to ``(actual column, predicted column)``.
    Rows where either side is null are ignored for that target; a series
    without a valid row has null metrics. MAPE is a fraction (not a percent);
    explained variance is 1 - var(e) / var(y).
    """
    aggs = [a for t, (y, yh) in pairs.items() for a in _target_aggs(t, y, yh, extended)]
    wide = df.groupBy(*group_cols).agg(*aggs)
    names = EXTENDED if extended else BASIC
    structs = []
    for t in pairs:
        m = _target_metrics(t, extended)
        for name in names:
            structs.append(F.struct(F.lit(t).alias("target"), F.lit(name).alias("metric"),
                                    m[name].cast("double").alias("value")))
    return wide.select(*group_cols, F.inline(F.array(*structs)))


def extended_metrics(df: DataFrame, pairs: dict[str, tuple[str, str]], group_cols=()) -> DataFrame:
    """A10: A9 plus MAPE (fraction) and explained variance."""
    return regression_metrics(df, pairs, group_cols, extended=True)


def fold_metrics_mean(metrics: DataFrame, group_cols=()) -> DataFrame:
    """Mean of per-fold metric rows ``(fold, target, metric, value)``."""
    return metrics.groupBy(*group_cols, "target", "metric").agg(F.avg("value").alias("value"))


def attach_stats(df: DataFrame, stats: DataFrame, group_cols) -> DataFrame:
    """Add per-series statistics to every row: an equi-join on the series keys (null
    equal to null) or, without series keys, the single statistics row as literals."""
    g = list(group_cols)
    if g:
        return join_series(df, stats, g, "inner")
    row = stats.first()
    return df.withColumns({c: F.lit(row[c]).cast(stats.schema[c].dataType) for c in stats.columns})


def _bounds(values: DataFrame, col: str, group_cols) -> DataFrame:
    """Range, number and sample deviation; without series keys computed once, as a local row."""
    b = values.groupBy(*group_cols).agg(
        F.min(col).alias("_lo"), F.max(col).alias("_hi"), F.count(col).alias("_n"),
        F.stddev_samp(col).alias("_sd"),
    )
    return b if group_cols else values.sparkSession.createDataFrame([tuple(b.first())], b.schema)


def residual_histogram(df: DataFrame, col: str = "residual", bins: int = 10, group_cols=()) -> DataFrame:
    """Counts of ``col`` in ``bins`` equal-width buckets from min to max.

    Buckets are numbered 1..bins; the maximum falls in the last bucket; empty
    buckets are listed with count 0. Where all values are equal, all are in
    bucket 1 and every bucket has width 0. A series without values has no row.
    """
    g = list(group_cols)
    vals = df.where(F.col(col).isNotNull())
    b = _bounds(vals, col, g).where("_n > 0")
    span = F.col("_hi") - F.col("_lo")
    width = span / F.lit(float(bins))
    raw = F.floor(F.try_divide(F.col(col) - F.col("_lo"), span) * F.lit(float(bins))) + 1
    bucket = F.when(span == 0, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")
    if not g and b.first() is None:
        return b.select(F.lit(1).alias("bucket"), "_lo", "_hi", F.col("_n").alias("count")).toDF("bucket", "bin_lo", "bin_hi", "count")
    counts = attach_stats(vals, b, g).groupBy(*g, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
    spine = b.select(*g, "_lo", "_hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bucket"))
    return join_series(spine, counts, [*g, "bucket"]).select(
        *g,
        "bucket",
        (F.col("_lo") + (F.col("bucket") - 1) * width).alias("bin_lo"),
        (F.col("_lo") + F.col("bucket") * width).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )


def residual_density(df: DataFrame, col: str = "residual", gridsize: int = 200, cut: float = 0.0,
                     group_cols=()) -> DataFrame:
    """Gaussian kernel density of ``col`` on an even grid.

    Bandwidth = n^(-1/5) * sample std (Scott's rule); the grid spans
    [min - cut*bw, max + cut*bw]. Equal values are counted first; each distinct
    value contributes a ``gridsize`` array of kernel values, weighted by its
    count, that is exploded and summed per grid point with partial aggregation.
    A series with fewer than two distinct values has no bandwidth and no row.
    """
    g = list(group_cols)
    vals = df.where(F.col(col).isNotNull())
    b = _bounds(vals, col, g).where("_sd > 0").withColumn(
        "_bw", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
    b = b.withColumns({
        "_g0": F.col("_lo") - F.lit(float(cut)) * F.col("_bw"),
        "_g1": F.col("_hi") + F.lit(float(cut)) * F.col("_bw"),
    })
    step = (F.col("_g1") - F.col("_g0")) / F.lit(float(max(gridsize - 1, 1)))
    norm = F.col("_n").cast("double") * F.col("_bw") * F.lit(math.sqrt(2 * math.pi))
    if not g and b.first() is None:
        return b.select(F.lit(0).alias("grid_index"), F.col("_lo").alias("x"), F.col("_hi").alias("density"))
    distinct = vals.groupBy(*g, F.col(col).alias("_x")).agg(F.count(F.lit(1)).alias("_w"))
    kernels = F.transform(
        F.sequence(F.lit(0), F.lit(gridsize - 1)),
        lambda i: F.col("_w") * F.exp(F.lit(-0.5) * F.pow((F.col("_g0") + i * step - F.col("_x")) / F.col("_bw"), 2)),
    )
    exploded = attach_stats(distinct, b, g).select(*g, F.posexplode(kernels).alias("grid_index", "_k"))
    sums = exploded.groupBy(*g, "grid_index").agg(F.sum("_k").alias("_s"))
    return attach_stats(sums, b, g).select(
        *g,
        F.col("grid_index").cast("int").alias("grid_index"),
        (F.col("_g0") + F.col("grid_index") * step).alias("x"),
        (F.col("_s") / norm).alias("density"),
    )


def forecast_summary(fc: DataFrame, group_cols=()) -> DataFrame:
    """Mean / max of both predictions and the number of alerts of each kind."""
    return fc.groupBy(*group_cols).agg(
        F.avg("predicted_admissions").alias("mean_predicted_admissions"),
        F.max("predicted_admissions").alias("max_predicted_admissions"),
        F.avg("predicted_occupancy").alias("mean_predicted_occupancy"),
        F.max("predicted_occupancy").alias("max_predicted_occupancy"),
        F.count_if(F.col("admission_alert")).cast("bigint").alias("admission_alerts"),
        F.count_if(F.col("occupancy_alert")).cast("bigint").alias("occupancy_alerts"),
        F.count(F.lit(1)).cast("bigint").alias("days"),
    )
