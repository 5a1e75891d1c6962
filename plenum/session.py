"""Session set-up and the shared folder that cuts lineage."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app_name: str = "plenum", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plenum-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application so its owner can expire it."""
    return f"{shared_folder(spark)}/plenum-{spark.sparkContext.applicationId}/{label}-{uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, executors may be lost.

    A Parquet table rather than ``checkpoint()``, because later rounds then prune columns and know the
    true size of what they join.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def store_bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """:func:`materialize` as a table bucketed and sorted by ``key``: later joins and sums by the key don't move its rows.

    Files lie in the shared folder; the catalogue of the session knows the table until :func:`discard`.
    """
    spark, path, name = df.sparkSession, scratch_path(df.sparkSession, label), f"plenum_{uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    stored = spark.table(name)
    stored.stored_at, stored.stored_as = path, name
    return stored


def discard(*stored: DataFrame | None) -> None:
    """Delete tables that :func:`materialize` or :func:`store_bucketed` wrote and nothing reads any more.

    Other frames and None are left alone.
    """
    for df in stored:
        path, name = getattr(df, "stored_at", None), getattr(df, "stored_as", None)
        if name is not None:
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
        if path is not None:
            place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
