"""Exact quantiles and modes of many columns without a single hot task.

Spark's exact ``percentile`` merges one counter per distinct value into one
task per group. Here one aggregate sketches every column and brackets each
quantile; a second pass unpivots the columns, counts what lies below a bracket
and keeps only the values inside it -- about 2 / ``accuracy`` of the rows --
which are counted by value with map-side combination and ranked. So the rows are
read twice, however many columns and quantiles are asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast.operators.keys import join_series
from daycast.session import local_frame

ACCURACY = 10_000


def exact_quantiles(df: DataFrame, col: str, probs, group_cols=(), accuracy: int = ACCURACY) -> DataFrame:
    """One row per series: n (non-null values) and q, the quantiles in the order of ``probs``.

    Linear interpolation between the two nearest ranks. A series without a
    value has n = 0 and null quantiles; without series keys there is always
    exactly one row.
    """
    return quantiles_of(df, [col], probs, group_cols, accuracy).select(*group_cols, "n", "q")


def sketches(df: DataFrame, cols, probs, group_cols=(), accuracy: int = ACCURACY) -> DataFrame:
    """One row per series: per column ``_k0``, ``_k1``, ...: n, nulls, lo, hi and s, the sketched bounds of every quantile's bracket."""
    shares = [s for p in probs for s in (max(0.0, p - 2.0 / accuracy), min(1.0, p + 2.0 / accuracy))]
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs.append(F.struct(F.count(v).alias("n"), F.count_if(v.isNull()).alias("nulls"), F.min(v).alias("lo"), F.max(v).alias("hi"),
                             F.percentile_approx(v, shares, accuracy).alias("s")).alias(f"_k{i}"))
    return df.groupBy(*group_cols).agg(*aggs)


def quantiles_of(df: DataFrame, cols, probs, group_cols=(), accuracy: int = ACCURACY, sketch=None) -> DataFrame:
    """One row per series and column: col, n, nulls and q as in :func:`exact_quantiles`.

    ``sketch``: the result of :func:`sketches` for the same columns and quantiles
    where the caller has it -- a table, or without series keys its one row.
    """
    g, cols, probs = list(group_cols), list(cols), [float(p) for p in probs]
    slack, short = 2.0 / accuracy, 10 * accuracy
    # A short series, and a bracket at an end of the range, takes all there is.
    from_lo, from_hi = [p <= slack for p in probs], [p >= 1 - slack for p in probs]
    if sketch is None:
        sketch = sketches(df, cols, probs, g, accuracy)
        sketch = sketch if g else sketch.first()
    if g:
        brackets = [
            F.struct(
                F.lit(c).alias("c"), F.lit(i).alias("i"), ((k["n"] - 1) * F.lit(p)).alias("at"),
                F.when(F.lit(from_lo[i]) | (k["n"] <= short), k["lo"]).otherwise(k["s"][2 * i]).alias("lo"),
                F.when(F.lit(from_hi[i]) | (k["n"] <= short), k["hi"]).otherwise(k["s"][2 * i + 1]).alias("hi"))
            for c, k in enumerate(F.col(f"_k{c}") for c in range(len(cols))) for i, p in enumerate(probs)]
        wanted = sketch.select(*g, F.array(*brackets).alias("_b"))
    else:
        known = [
            (c, i, (k["n"] - 1) * p, k["lo"] if from_lo[i] or k["n"] <= short else k["s"][2 * i], k["hi"] if from_hi[i] or k["n"] <= short else k["s"][2 * i + 1])
            for c, k in enumerate(sketch) for i, p in enumerate(probs) if k["n"]]
    values = df.select(*g, F.array(*[F.col(c).cast("double") for c in cols]).alias("_v"))
    if g:
        marked = join_series(values, wanted, g, "inner")
    elif known:
        marked = values.withColumn("_b", F.array(*[
            F.struct(*[F.lit(x).cast(t).alias(name) for x, (name, t) in zip(b, (("c", "int"), ("i", "int"), ("at", "double"), ("lo", "double"), ("hi", "double")))])
            for b in known]))
    else:
        marked = None
    found = None if marked is None else _ranked(marked, g)
    if not g:  # a row per column and quantile
        rows = {} if found is None else {(r["c"], r["i"]): r["v"] for r in found.collect()}
        made = [(name, k["n"], k["nulls"], [rows.get((c, i)) for i in range(len(probs))]) for c, (name, k) in enumerate(zip(cols, sketch))]
        return local_frame(df.sparkSession, {"col": "string", "n": "long", "nulls": "long", "q": "array<double>"}, made)
    sizes = sketch.select(*g, F.inline(F.array(*[
        F.struct(F.lit(i).alias("c"), F.lit(name).alias("col"), F.col(f"_k{i}")["n"].alias("n"), F.col(f"_k{i}")["nulls"].alias("nulls")) for i, name in enumerate(cols)])))
    lists = found.groupBy(*g, "c").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("_q"))
    empty = F.array(*[F.lit(None).cast("double")] * len(probs))
    q = F.coalesce(F.transform("_q", lambda x: x["v"]), empty).alias("q")
    return join_series(sizes, lists, [*g, "c"]).select(*g, "col", "n", "nulls", q)


def _ranked(marked: DataFrame, g: list[str]) -> DataFrame:
    """(series, c, i, v): every bracket's quantile, from rows with the values ``_v`` and the brackets ``_b``."""
    at_or_below = F.filter("_b", lambda b: F.get("_v", b["c"]) <= b["hi"])
    placed = marked.select(*g, "_v", F.explode(at_or_below).alias("b")).select(*g, "b.c", "b.i", "b.at", F.get("_v", F.col("b.c")).alias("_x"), F.col("b.lo").alias("_lo"))
    # What lies below the bracket counts as one value.
    inside = placed.select(*g, "c", "i", "at", F.when(F.col("_x") >= F.col("_lo"), F.col("_x")).alias("_v"))
    counted = inside.groupBy(*g, "c", "i", "at", "_v").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*g, "c", "i").orderBy(F.col("_v").asc_nulls_first())
    ranked = counted.withColumn("_end", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    low, high = F.floor("at"), F.ceil("at")
    holds = lambda rank: (rank >= F.col("_end") - F.col("_n")) & (rank < F.col("_end"))
    found = ranked.groupBy(*g, "c", "i").agg(
        F.max(F.when(holds(low), F.col("_v"))).alias("lo"), F.max(F.when(holds(high), F.col("_v"))).alias("hi"), F.first("at").alias("at"))
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))
    return found.select(*g, "c", "i", value.alias("v"))


def modes(df: DataFrame, col: str, group_cols=()) -> DataFrame:
    """One row per series with a value: ``mode``, the commonest non-null value, the least one on ties."""
    return modes_of(df, [col], group_cols).where(F.col(col).isNotNull()).withColumnRenamed(col, "mode")


def modes_of(df: DataFrame, cols, group_cols=()) -> DataFrame:
    """One row per series with a value in any of ``cols``: each column's commonest non-null value, the least one on ties.

    All columns are unpivoted and counted in one pass; columns of one type share a field.
    """
    g, cols = list(group_cols), list(cols)
    types = {c: df.schema[c].dataType.simpleString() for c in cols}
    fields = {t: f"_t{i}" for i, t in enumerate(dict.fromkeys(types.values()))}
    cells = [F.struct(F.lit(i).alias("_c"), *[(F.col(c) if types[c] == t else F.lit(None).cast(t)).alias(f) for t, f in fields.items()]) for i, c in enumerate(cols)]
    present = F.filter(F.array(*cells), lambda x: F.exists(F.array(*[x[f].isNotNull() for f in fields.values()]), lambda known: known))
    counts = df.select(*g, F.inline(present)).groupBy(*g, "_c", *fields.values()).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*g, "_c").agg(F.min(F.struct((-F.col("_n")).alias("a"), *[F.col(f) for f in fields.values()])).alias("_m"))
    return best.groupBy(*g).agg(*[F.max(F.when(F.col("_c") == i, F.col("_m")[fields[types[c]]])).alias(c) for i, c in enumerate(cols)])
