"""Views of the driver's parquet tables as visit records.

Two sources stand in for patient visits:

* ``orders`` + ``lineitem`` (one series): an order is a visit that arrives on
  its order date, leaves on its last ship date, waits one hour per line, sees
  twice its mean line quantity as bed occupancy, is an emergency when urgent
  and needs intensive care when fulfilled.
* ``events`` (one series per ``event_type``): an event is a visit at ``ts``
  with ``value`` as occupancy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast import schema as S

V = S.VISIT_COLUMNS


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def visits_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 visit records from orders and their line items (single series).

    The line items are aggregated per order first (partial aggregation absorbs
    hot orders), and the result, already hash-partitioned on the order key,
    is joined to the orders.
    """
    lines = (
        load(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.max("l_shipdate").alias("last_ship"),
            F.count(F.lit(1)).alias("n_lines"),
            F.avg("l_quantity").alias("avg_qty"),
        )
    )
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    return joined.select(
        F.col("o_orderkey").alias(V["patient"]),
        F.col("o_orderdate").alias(V["arrival"]),
        F.col("last_ship").alias(V["departure"]),
        F.concat(F.col("n_lines").cast("string"), F.lit(" h")).alias(V["waiting"]),
        F.concat((F.col("avg_qty") * 2).cast("string"), F.lit("%")).alias(V["occupancy"]),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(S.EMERGENCY_LABEL))
        .otherwise(F.lit("Programmée"))
        .alias(V["admission_type"]),
        F.when(F.col("o_orderstatus") == "F", F.lit(S.YES_LABEL)).otherwise(F.lit("Non")).alias(V["icu"]),
    )


def visits_from_events(spark: SparkSession, sf_dir: str, series_col: str = "event_type") -> DataFrame:
    """F1 visit records from events; ``series_col`` names the series."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.col(series_col),
        F.col("event_id").alias(V["patient"]),
        F.col("ts").alias(V["arrival"]),
        F.concat(F.col("value").cast("string"), F.lit("%")).alias(V["occupancy"]),
    )
