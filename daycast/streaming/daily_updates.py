"""Daily aggregate kept up to date from a file stream of visit records.

The batch path reads every visit again to rebuild the daily series. Here each
micro-batch of new files is reduced to partial sums per (series, day) and
written under its batch number; reading the table adds the partials up. So
every day is there as soon as its first file is, a late visit still counts in
its day, and a batch that is run again replaces its own partials. The result
has the columns of the batch aggregate without imputation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daycast import schema as S
from daycast.functions import columns as C
from daycast.operators.daily import MEASURES
from daycast.operators.prepare import enrich_visits
from daycast.session import scratch_path

V = S.VISIT_COLUMNS


def partial_daily(visits: DataFrame, group_cols=(), names: dict[str, str] | None = None) -> DataFrame:
    """Sums and counts per (series, day) that add up over batches; a null date holds the undated visits."""
    v = {**V, **(names or {})}
    e = enrich_visits(visits, names)
    aggs = [F.count(F.col(v["patient"])).alias("_patients")]
    aggs += [F.sum(flag).cast("bigint").alias(flag) for flag in ("isEmergency", "needsICU") if flag in e.columns]
    for src, out in MEASURES:
        if src in e.columns:
            aggs += [F.sum(src).alias(f"_s_{out}"), F.count(src).alias(f"_c_{out}")]
    return e.groupBy(*group_cols, F.to_date(F.col(v["arrival"])).alias(S.DATE)).agg(*aggs)


def merged_daily(partials: DataFrame, group_cols=()) -> DataFrame:
    """A1 from the partials of all batches: one row per (series, day)."""
    sums = [F.sum(c).alias(c) for c in partials.columns if c not in (*group_cols, S.DATE, "batch")]
    total = partials.where(F.col(S.DATE).isNotNull()).groupBy(*group_cols, S.DATE).agg(*sums)
    out = [F.col("_patients").cast("double").alias(S.ADMISSIONS)]
    out += [F.col(flag) for flag in ("isEmergency", "needsICU") if flag in total.columns]
    out += [F.try_divide(F.col(f"_s_{o}"), F.col(f"_c_{o}").cast("double")).alias(o) for _, o in MEASURES if f"_s_{o}" in total.columns]
    return total.select(*group_cols, S.DATE, *out).withColumns(C.calendar_columns(S.DATE))


def start_daily_updates(spark: SparkSession, source: str, schema, output_path: str, checkpoint_location: str,
                        fmt: str = "parquet", group_cols=(), names: dict[str, str] | None = None,
                        available_now: bool = True, prepare=None, glob: str | None = None) -> StreamingQuery:
    """Start the stream: ``source`` files (``fmt``) -> partials under ``output_path/batch=N``.

    ``source`` is a directory; ``glob`` keeps only matching file names.
    ``prepare`` maps the raw stream to visit records (F1 columns) when the
    files are not in that shape already.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.load(source)

    def write(batch: DataFrame, number: int) -> None:
        visits = prepare(batch) if prepare is not None else batch
        partial_daily(visits, group_cols, names).write.mode("overwrite").parquet(f"{output_path}/batch={number}")

    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_daily_updates(spark: SparkSession, output_path: str, group_cols=()) -> DataFrame:
    """The daily table as of now."""
    return merged_daily(spark.read.parquet(output_path), group_cols)


def run_daily_updates(spark: SparkSession, source: str, schema, fmt: str = "parquet", group_cols=(),
                      prepare=None, name: str = "daily-updates", glob: str | None = None) -> DataFrame:
    """Process everything available now into a table under the checkpoint folder and read it."""
    run = f"{name}-{uuid.uuid4().hex}"
    out = scratch_path(spark, run + "/table")
    q = start_daily_updates(spark, source, schema, out, scratch_path(spark, run + "/state"), fmt,
                            group_cols, None, True, prepare, glob)
    q.awaitTermination()
    return read_daily_updates(spark, out, group_cols)
