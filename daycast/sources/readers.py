"""Readers and writers."""

from __future__ import annotations

import datetime as _dt
import logging
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from daycast import schema as S
from daycast.functions.columns import parse_timestamp

log = logging.getLogger(__name__)

_TIME_TYPES = (TimestampType, TimestampNTZType, DateType)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             date_column: str | None = S.DATE, formats=S.DATE_FORMATS) -> DataFrame:
    """CSV with header; ``date_column`` is parsed to a timestamp (ISO text, then ``formats``), bad values become null.

    Give ``schema`` on production paths; without it every column is read as text
    (no inference pass over the data).
    """
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if date_column and date_column in df.columns:
        df = df.withColumn(date_column, _as_timestamp(df, date_column, formats))
    return df


def _as_timestamp(df: DataFrame, name: str, formats=S.DATE_FORMATS):
    dtype = df.schema[name].dataType
    if isinstance(dtype, _TIME_TYPES):
        return F.col(name).cast("timestamp")
    return parse_timestamp(name, formats)


def coerce_date_columns(df: DataFrame, patterns=S.DATE_NAME_PATTERNS, formats=S.DATE_FORMATS) -> DataFrame:
    """Every column whose lower-cased name contains a pattern becomes a timestamp.

    Text that is neither ISO nor in one of ``formats`` becomes null;
    ``prepare.visit_quality`` counts visits that this leaves without a day.
    """
    pats = [p.lower() for p in patterns]
    targets = [c for c in df.columns if any(p in c.lower() for p in pats)]
    if not targets:
        return df
    return df.withColumns({c: _as_timestamp(df, c, formats) for c in targets})


def read_by_extension(spark: SparkSession, path: str, schema: StructType | str | None = None,
                      date_column: str | None = S.DATE) -> DataFrame:
    """Pick the reader from the extension: .csv, .parquet, .json; anything else is an error."""
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext == ".csv":
        return read_csv(spark, path, schema, date_column)
    if ext == ".parquet":
        df = spark.read.parquet(path)
    elif ext == ".json":
        df = (spark.read.schema(schema) if schema is not None else spark.read).json(path)
    else:
        raise ValueError(f"unsupported file format: {path!r} (use .csv, .parquet or .json)")
    if date_column and date_column in df.columns:
        df = df.withColumn(date_column, _as_timestamp(df, date_column))
    return df


EXTENSIONS = (".csv", ".parquet", ".json")


def latest_table(spark: SparkSession, directory: str, extensions=EXTENSIONS) -> str:
    """Path of the most recently written table in ``directory``: a file, or a folder of part
    files, whose name ends in one of ``extensions``.

    Only file metadata is listed (the binary content column is pruned). A
    folder is as new as its newest part.
    """
    base = directory.rstrip("/")
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(base)
            .select("path", "modificationTime")
        )
        # What follows the directory's name; the listed path has the file system's scheme.
        name = F.split_part(F.element_at(F.split("path", F.lit("\\Q" + base.split("://")[-1] + "/\\E")), -1), F.lit("/"), F.lit(1))
        tables = files.groupBy(name.alias("name")).agg(F.max("modificationTime").alias("at"))
        wanted = F.lit(False)
        for e in extensions:
            wanted = wanted | F.lower("name").endswith(e)
        row = tables.where(wanted).orderBy(F.desc("at"), F.desc("name")).limit(1).collect()
    except Exception as exc:  # missing directory surfaces as an analysis error
        raise FileNotFoundError(f"directory {directory!r} cannot be listed: {exc}") from exc
    if not row:
        raise FileNotFoundError(f"no table ending in {', '.join(extensions)} in {directory!r}")
    return f"{base}/{row[0]['name']}"


def read_latest(spark: SparkSession, directory: str, schema=None, date_column: str | None = S.DATE,
                extensions=EXTENSIONS) -> DataFrame:
    """The most recent table of a directory, all its parts, read by its extension."""
    return read_by_extension(spark, latest_table(spark, directory, extensions), schema, date_column)


def _stamp() -> str:
    return _dt.datetime.now().strftime("%Y%m%d_%H%M%S")


def write_table(df: DataFrame, directory: str, name: str | None = None, fmt: str = "parquet",
                mode: str = "overwrite") -> str:
    """Write ``df`` under ``directory``; the default name is ``processed_data_<timestamp>``.

    The name ends in the format's extension, so that :func:`read_latest` finds it.

    Returns the written path (a directory of part files).
    """
    name = name or f"processed_data_{_stamp()}"
    if not name.lower().endswith(f".{fmt}"):
        name += f".{fmt}"
    path = directory.rstrip("/") + "/" + name
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)
    return path


def write_json_result(df: DataFrame, directory: str, name: str, mode: str = "overwrite") -> str:
    """Alerts, metrics and run summaries as JSON lines."""
    path = directory.rstrip("/") + "/" + name
    df.write.mode(mode).json(path)
    return path


def attach_daily_dates(df: DataFrame, end, order_col: str, group_cols=(), date_col: str = S.DATE) -> DataFrame:
    """For a daily history without dates: number the rows by ``order_col`` (per series)
    and give them consecutive days ending at ``end``.

    Meant for daily-grain tables: each series is one window partition.
    """
    g = list(group_cols)
    w_order = Window.partitionBy(*g).orderBy(F.col(order_col).asc_nulls_first())
    w_all = Window.partitionBy(*g)
    end_col = F.lit(end).cast("date") if not hasattr(end, "_jc") else end.cast("date")
    n = F.count(F.lit(1)).over(w_all)
    rn = F.row_number().over(w_order)
    return df.withColumn(date_col, F.date_sub(end_col, (n - rn).cast("int")))
