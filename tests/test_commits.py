import pytest
from pyspark.sql import functions as F

from cartloom import schemas
from cartloom.operators.sessions import session_metrics
from cartloom.session import new_path
from cartloom.sources import fixtures, readers
from cartloom.streaming import commits


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_metrics_equal_batch_at_any_number_of_files(spark, small):
    rows = fixtures.interactions(spark, small).select(*schemas.INTERACTIONS.names)
    source, table, check = (new_path(spark, n) for n in ("in", "sums", "check"))
    # Files in no order of time; sessions lie in several files.
    for part in (0, 1, 2):
        rows.filter(F.pmod(F.xxhash64("session_id", "timestamp_local"), F.lit(3)) == part).repartition(5).write.mode("append").parquet(source)
        got = commits.session_metrics_so_far(spark, source, table, check, files_per_batch=2)
        assert rows_of(got) == rows_of(session_metrics(spark.read.schema(schemas.INTERACTIONS).parquet(source)))
    batches = {r[0] for r in spark.read.parquet(table).select("batch").distinct().collect()}
    assert len(batches) > 3
    again = commits.session_metrics_so_far(spark, source, table, check)
    assert rows_of(again) == rows_of(session_metrics(rows))
    smaller = new_path(spark, "compact")
    commits.compact(spark, table, smaller)
    assert rows_of(commits.session_metrics_so_far(spark, source, smaller, check)) == rows_of(session_metrics(rows))
    assert commits.read_committed(spark, smaller, commits.SESSION_SUMS).count() == session_metrics(rows).count()


def test_midnight_and_no_files(spark):
    data = [(1, "2024-05-01 23:59:00", 5, 1), (1, "2024-05-03 00:01:00", 5, 0), (2, "2024-05-09 10:00:00", 5, 0), (3, "2024-05-09 10:00:00", None, 1)]
    rows = spark.createDataFrame(data, "session_id long, t string, user_id long, add_to_cart int").select(
        "session_id", F.to_timestamp_ntz("t").alias("timestamp_local"), "user_id", F.col("add_to_cart").cast("tinyint").alias("add_to_cart"))
    source, table, check = (new_path(spark, n) for n in ("in", "sums", "check"))
    rows.limit(0).write.parquet(source)
    assert commits.session_metrics_so_far(spark, source, table, check).count() == 0
    rows.repartition(4).write.mode("append").parquet(source)
    got = commits.session_metrics_so_far(spark, source, table, check, files_per_batch=1)
    assert rows_of(got) == [(5, 1, 86520.0, 50.0), (5, 2, 0.0, 0.0)]


def test_broken_off_batch_counts_once(spark, small):
    users = fixtures.users(spark, small)
    source, table, check = (new_path(spark, n) for n in ("in", "users", "check"))
    users.repartition(6).write.parquet(source)
    stream = spark.readStream.schema(schemas.USERS).option("maxFilesPerTrigger", 2).parquet(source)
    calls = []

    def fails_late(rows):
        calls.append(1)
        if len(calls) == 2:
            # The batch is written, but not marked as done.
            commits.write_batch(readers.cast_users(rows), 1, table)
            raise RuntimeError("lost")
        return readers.cast_users(rows)

    with pytest.raises(Exception, match="lost"):
        commits.commit_new(stream, table, check, fails_late)
    assert 0 < commits.read_committed(spark, table, schemas.USERS).count() < users.count()
    merged = commits.merge_new_users(spark, source, table, check, files_per_batch=2)
    assert rows_of(merged) == rows_of(readers.merge_batches(spark, source))
    users.limit(3).write.mode("append").parquet(source)
    assert commits.merge_new_users(spark, source, table, check).count() == users.count() + 3
