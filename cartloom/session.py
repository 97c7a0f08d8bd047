"""Session settings and shared-folder hand-off between jobs."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more shuffle above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """The settings every job of this package is designed for."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def single_machine_folder(spark: SparkSession) -> None:
    """Name a temporary checkpoint folder where the session has none and all its tasks run in this process's machine."""
    if not _folder(spark) and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cartloom-"))


def _folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see: the cluster's `spark.checkpoint.dir`. There is no fallback."""
    folder = _folder(spark)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")


def _drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of staged tables, if the session is still there to do it."""
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended; the folder goes with the cluster's checkpoints
        return


def _run_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder, deleted when the driver's Python ends."""
    path = f"{shared_folder(spark)}/staged-{spark.sparkContext.applicationId}"
    if path not in _RUN_FOLDERS:
        _RUN_FOLDERS.add(path)
        atexit.register(_drop_folder, spark, path)
    return path


_RUN_FOLDERS: set[str] = set()


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in this application's part of the shared folder."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_new(df: DataFrame, name: str, **options) -> tuple[DataFrame, str]:
    """`df` written once to the shared folder, as read from there, and its path."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**{"compression": "zstd"} | options).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_written(spark: SparkSession, path: str) -> None:
    """Delete a table of `write_new` that nothing reads any more, before the run ends."""
    _drop_folder(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and go on from the files.

    Cuts the lineage: a lost executor re-reads the files and does not repeat the work before them.
    """
    return write_new(df, name)[0]
