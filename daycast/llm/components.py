"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is the least node reachable.

    Each step hangs neighbours on the least node of a neighbourhood. Minima are
    combined map-side and joined back, so a node with very many neighbours is no
    single task; the edge table never grows. Steps end when the table stays the
    same, after about log(nodes) steps at most. No edges give no rows.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        large = _star(now.union(now.select("b", "a")), lambda v, u: v > u)
        now = materialize(_star(large.union(large.select("b", "a")).where("b <= a"), None), "links")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    heads = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(heads.distinct())


def _star(edges: DataFrame, keep) -> DataFrame:
    """For each u with neighbours v and m = min(u, v...): edges (v, m) of the kept v, and (u, m)."""
    # Written, so that both sides of the join are plain exchanges and a hub's edges can be split.
    least = materialize(edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).withColumn("m", F.least("u", "m")), "links-least")
    joined = edges.join(least, edges["a"] == least["u"])
    pairs = joined if keep is None else joined.where(keep(F.col("b"), F.col("u")))
    out = pairs.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if keep is None:
        out = out.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()
