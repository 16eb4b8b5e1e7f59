"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLOCK_ROWS = 4000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z; every other letter stays as it is."""
    return F.translate(col, UPPER, UPPER.lower())


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces_of(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """Zero-copy pieces of at most ``rows`` rows, to bound the work arrays of one step."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


_KEPT: dict[tuple, object] = {}


def kept(key: tuple, make):
    """What an operator's tasks keep in their worker process; what another operator kept there goes first."""
    if key not in _KEPT:
        drop_kept()
        _KEPT[key] = make()
    return _KEPT[key]


def drop_kept() -> None:
    """At the start of a task that keeps nothing: the room that another operator's kept caches took."""
    if _KEPT:
        _KEPT.clear()
        give_back()


def give_back() -> None:
    """At a task's end: Arrow's free memory back to the system, as an idle worker should not hold it."""
    pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; nulls become empty texts."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw, at - at[0]


def ordered_blocks(df: DataFrame, key: str, rows: int = BLOCK_ROWS) -> list[int]:
    """Lower bounds of consecutive key ranges of about ``rows`` rows.

    The bounds are actual key values from one pruned, map-side combined pass
    (``percentile_approx``). Their number follows the row count but is at most
    16 per shuffle partition, so what the driver holds stays small.
    """
    n = df.select(key).count()
    parts = max(1, min(-(-n // rows), 16 * partitions(df.sparkSession)))
    if parts == 1:
        return []
    shares = [i / parts for i in range(1, parts)]
    got = df.agg(F.percentile_approx(key, shares, 20 * parts).alias("p")).first()["p"]
    return sorted(set(got or []))


def deal_key(spark: SparkSession, index: Column, n: int) -> Column:
    """A key that ``repartition(n, key)`` sends to partition ``index``: one block a task, none with several.

    For each partition one number whose hash falls there, found on the numbers themselves.
    """
    found = spark.range(20 * n + 200).select(F.pmod(F.hash(F.col("id").cast("int")), F.lit(n)).alias("p"), F.col("id").cast("int").alias("k")).groupBy("p").agg(F.min("k").alias("k")).collect()
    keys = dict(found)
    return F.element_at(F.lit([keys.get(i, i) for i in range(n)]), index + 1)


def block_of(key: Column, bounds: list[int]) -> Column:
    """Number of ``bounds`` that are at most ``key`` -- its range; null keys are in range 0.

    Looks through every k-th bound first, then through the k that follow.
    """
    if not bounds:
        return F.lit(0)
    k = max(1, round(len(bounds) ** 0.5))
    edges, coarse = (F.lit([int(b) for b in x]) for x in (bounds, bounds[::k]))
    group = F.size(F.filter(coarse, lambda e: e <= key))
    near = F.slice(edges, F.greatest((group - 1) * k + 1, F.lit(1)), k)
    inside = F.size(F.filter(near, lambda e: e <= key))
    return F.when(key.isNull() | (group == 0), 0).otherwise((group - 1) * k + inside)


def in_order(df: DataFrame, key: str, tie: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` dealt out by ranges of the long column ``key``, ordered inside each task, with the range's number in ``block``.

    Blocks and the rows in them are in ascending order of ``key`` (nulls first),
    then of a hash of ``tie``, then of ``tie``. A key or null that fills several
    blocks is divided among them by that hash, so no key is one task's work. The
    bounds come from ``percentile_approx`` on the key alone; there are at most 16
    per shuffle partition.
    """
    spark = df.sparkSession
    n, nulls = df.agg(F.count(F.lit(1)), F.count_if(F.col(key).isNull())).first()
    parts = max(1, min(-(-n // rows), 16 * partitions(spark)))
    empty = -(-nulls * parts // n) if nulls else 0
    shares = [i / parts for i in range(1, parts)]
    bounds = (df.agg(F.percentile_approx(key, shares, 20 * parts).alias("p")).first()["p"] or []) if shares else []
    col, share = F.col(key), F.pmod(F.xxhash64(tie), F.lit(1 << 20)) / float(1 << 20)
    if bounds:
        k = max(1, round(len(bounds) ** 0.5))
        edges, coarse = (F.lit([int(b) for b in x]) for x in (bounds, bounds[::k]))

        def count(under) -> Column:
            group = F.size(F.filter(coarse, under))
            inside = F.size(F.filter(F.slice(edges, F.greatest((group - 1) * k + 1, F.lit(1)), k), under))
            return F.when(group == 0, 0).otherwise((group - 1) * k + inside)

        below, upto = count(lambda e: e < col), count(lambda e: e <= col)
        place = F.when(upto > below, below + 1 + F.floor(share * (upto - below)).cast("int")).otherwise(below)
    else:
        place = F.lit(0)
    block = F.when(col.isNull(), F.floor(share * empty).cast("int")).otherwise(place + empty)
    n_blocks = len(bounds) + 1 + empty
    keyed = df.withColumn("block", block.cast("int"))
    dealt = keyed.repartition(n_blocks, deal_key(spark, F.col("block"), n_blocks))
    return dealt.sortWithinPartitions("block", F.col(key).asc_nulls_first(), F.xxhash64(tie), tie)
