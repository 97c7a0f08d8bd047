"""New files of a folder, batch by batch into a table: each batch counts once, whatever is broken off in between.

A batch's rows go to a folder of their own, named by the batch's number. The stream's checkpoint says which files belong to which
number; a batch that is run again, because its first run was broken off or was not yet marked as done, replaces that folder.
Before a batch's job has ended its files are hidden from readers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom import schemas
from cartloom.operators.sessions import session_aggregates, session_metric_columns
from cartloom.sources.readers import cast_users

# The column that numbers the batches of a table.
BATCH = "batch"


def write_batch(rows: DataFrame, number: int, table: str) -> None:
    """Rows of one batch, in place of what an earlier run of the same batch has left."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{table}/{BATCH}={number}")


def commit_new(stream: DataFrame, table: str, checkpoint: str, change: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Run a stream over all files that are new since the checkpoint; `change` turns a batch into the table's rows."""
    query = (
        stream.writeStream.foreachBatch(lambda rows, number: write_batch(change(rows), number, table))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_committed(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches so far; none for a table without a batch."""
    # An empty batch of its own, so that there is a folder to read.
    write_batch(spark.createDataFrame([], schema), -1, table)
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(table).drop(BATCH)


def _files(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def merge_new_users(spark: SparkSession, folder: str, table: str, checkpoint: str, files_per_batch: int = 100) -> DataFrame:
    """User batches fetched so far as one table; files merged by an earlier call aren't read again."""
    commit_new(_files(spark, folder, schemas.USERS, files_per_batch), table, checkpoint, cast_users)
    return read_committed(spark, table, schemas.USERS)


#: Sums of a session that add up over batches.
SESSION_SUMS = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("session_id", T.LongType()),
    T.StructField("first_seen", T.TimestampNTZType()), T.StructField("last_seen", T.TimestampNTZType()),
    T.StructField("adds", T.LongType()), T.StructField("rows", T.LongType()),
])


def _sums(rows: DataFrame) -> DataFrame:
    known = session_aggregates(rows.filter(F.col("user_id").isNotNull()))
    return known.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SESSION_SUMS])


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("user_id", "session_id").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("adds").alias("adds"), F.sum("rows").alias("rows")
    )


def session_metrics_so_far(spark: SparkSession, folder: str, table: str, checkpoint: str, files_per_batch: int = 1000) -> DataFrame:
    """Session metrics over all interaction files there are by now, each of which is read in one call only.

    Kept are four sums per session and batch, not rows and no open windows. So no row comes too late, sessions may last
    over midnight or for days, and the result is that of `session_metrics` over all files, in whatever order they came.
    """
    commit_new(_files(spark, folder, schemas.INTERACTIONS, files_per_batch), table, checkpoint, _sums)
    return _summed(read_committed(spark, table, SESSION_SUMS)).select(*session_metric_columns())


def compact(spark: SparkSession, table: str, target: str) -> None:
    """The session sums of all batches as one batch of the table `target`; go on there with the same checkpoint.

    Numbers of later batches are larger than those summed up, so nothing is replaced.
    """
    write_batch(_summed(read_committed(spark, table, SESSION_SUMS)), -2, target)
