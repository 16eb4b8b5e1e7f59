"""Exact dedup by heavy-hitter split, with DataFrame functions only.

A Misra-Gries summary (Spark's ``approx_top_k``, a frequent-items sketch of
that family) names the digests that may hold a large share of the rows. Their
exact counts are verified, the winners -- at most ``hot_keys`` rows -- are
broadcast, and their rows are resolved map-side without a shuffle. All other
digests, each below ``rows / hot_keys`` rows, take an ordinary hash shuffle of
(digest, id) rows; texts never move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast.llm.common import ascii_lower
from daycast.session import materialize

#: A digest with at least 1 / HOT_KEYS of the rows is a heavy hitter.
HOT_KEYS = 64
#: Counters of the summary; its error is below the hot share at this size.
COUNTERS = 4096


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_keys: int = HOT_KEYS, counters: int = COUNTERS) -> DataFrame:
    """Group rows whose texts are equal after lower-casing A-Z.

    Returns one row per input row: ``id_col``, keep_id (largest id of the
    group), group_size, kept, text_sha256 (hex of the normalised UTF-8 text).
    Null texts count as empty and form one group with empty texts. Of rows that
    share the largest id exactly one is kept. Null ids lose to every other id;
    a group of null ids only has keep_id null and one kept row. Other columns
    are ignored, whatever their names. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            F.sha2(ascii_lower(text).cast("binary"), 256).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact-digests",
    )
    who = F.struct(F.col("id").isNotNull().alias("has"), "id", "row")
    hot = materialize(heavy_hitters(rows, "digest", F.max(who).alias("keep"), hot_keys, counters), "exact-hot")

    split = rows.join(F.broadcast(hot), "digest", "left")
    same = Window.partitionBy("digest")
    frequent = split.where(F.col("n").isNotNull())
    others = (
        split.where(F.col("n").isNull())
        .select("id", "digest", "row")
        .withColumns({"n": F.count(F.lit(1)).over(same), "keep": F.max(who).over(same)})
    )
    return frequent.unionByName(others.select(*frequent.columns)).select(
        F.col("id").alias(id_col),
        F.col("keep.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def heavy_hitters(rows: DataFrame, key: str, winner, hot_keys: int, counters: int) -> DataFrame:
    """(key, n, winner) of every key with at least 1 / ``hot_keys`` of all rows; at most ``hot_keys`` rows."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    named = rows.agg(F.expr(f"approx_top_k({key}, {2 * hot_keys}, {counters})").alias("top")).select(F.explode("top.item").alias(key))
    counted = rows.join(F.broadcast(named), key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n"), winner)
    return counted.join(F.broadcast(total), F.col("n") * hot_keys >= F.col("total")).drop("total")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns; equal (id, text) rows stay once.

    Only the rows of groups with more than one member are looked up: the
    losers' (id, digest) pairs are removed by an anti join.
    """
    groups = exact_duplicates(docs, id_col, text_col)
    digest, key = "__exact_digest", "__exact_id"
    lost = groups.where("group_size > 1").where(~F.col("kept")).select(F.col(id_col).alias(key), F.col("text_sha256").alias(digest), F.col("keep_id"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.withColumn(digest, F.sha2(ascii_lower(text).cast("binary"), 256))
    # A repeated (id, text) row shares its key with the row that stays: remove the others first, then the repeats.
    other = lost.where(~F.col(key).eqNullSafe(F.col("keep_id"))).select(key, digest).distinct()
    on = keyed[id_col].eqNullSafe(other[key]) & (keyed[digest] == other[digest])
    left = keyed.join(other, on, "left_anti")
    repeats = lost.where(F.col(key).eqNullSafe(F.col("keep_id"))).select(key, digest).distinct()
    hit = left[id_col].eqNullSafe(repeats[key]) & (left[digest] == repeats[digest])
    once = left.join(repeats, hit, "left_semi").dropDuplicates([id_col, digest])
    return left.join(repeats, hit, "left_anti").unionByName(once).drop(digest)
