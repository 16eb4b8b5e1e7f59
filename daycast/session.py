"""Session helpers: local sessions for tests/bench and checkpoint handling."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: Tables written by ``materialize``, by application.
_WRITTEN: dict[str, list[str]] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "daycast") -> SparkSession:
    """A local session configured like the cluster jobs expect (UTC, AQE, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` (or one already set on the context)
    is used as is. When none is configured, a fresh scratch folder is created
    for a single-process ``local[...]`` session only; on a cluster a
    machine-local folder would scatter the files, so that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="daycast-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    One job computes the rows once; the returned frame's lineage starts at the
    written files, which survive executor loss.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path, compression=compression)
    _WRITTEN.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return df.sparkSession.read.parquet(path)


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}


def local_frame(spark: SparkSession, columns: dict[str, str], rows) -> DataFrame:
    """A small frame that the plan itself holds: reading it takes no job. ``columns`` maps names to types."""
    values = list(zip(*rows)) or [()] * len(columns)
    return spark.createDataFrame(pa.table([pa.array(v, _ARROW[t]) for v, t in zip(values, columns.values())], names=list(columns)))


def clear_tables(spark: SparkSession) -> int:
    """Delete the tables :func:`materialize` wrote in this application; returns their number.

    For the owner of a job, once its results are stored: frames that read the tables end here.
    """
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    jvm = spark._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name
