"""Session metrics kept up to date while interactions arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom import schemas
from cartloom.session import new_path
from cartloom.operators.sessions import session_metric_columns, session_sums


def read_interaction_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a folder as a stream of interactions."""
    return (
        spark.readStream.schema(schemas.INTERACTIONS)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def session_metrics_stream(interactions: DataFrame, *, late: str = "3 days", longest: str = "3 days") -> DataFrame:
    """The batch metrics as a running aggregation, for output mode "append" or "update".

    A session's rows lie within `longest` of midnight-aligned time, rows come at most `late` after newer
    ones. State is four numbers per open session of a known user and ends with its time range: "append"
    gives a session once, when no row of it can follow.
    """
    known = interactions.filter(F.col("user_id").isNotNull() & F.col("timestamp_local").isNotNull())
    timed = known.withColumn("_ts", F.col("timestamp_local").cast("timestamp")).withWatermark("_ts", late)
    open_sessions = timed.groupBy(F.window("_ts", longest).alias("_range"), "user_id", "session_id").agg(*session_sums())
    return open_sessions.select(*session_metric_columns())


def run_available(stream: DataFrame) -> DataFrame:
    """Run a stream over all that is there now, into files of the shared folder, and read those: what is final by then."""
    spark, path = stream.sparkSession, new_path(stream.sparkSession, "stream")
    query = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-state")
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
