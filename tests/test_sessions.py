"""Session metrics: the shapes a caller relies on."""

import pytest
from pyspark.sql import functions as F

from cartloom.operators.sessions import calendar_features, fill_session_max, fill_session_mean, session_metrics

COLUMNS = ["user_id", "session_id", "total_session_time", "cart_addition_ratio"]


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (9, 30, "2024-06-01 10:00:00.000", 0), (9, 30, "2024-06-01 10:02:10.250", 1),
        (9, 12, "2024-06-02 08:00:00.000", 1),
        (8, 40, "2024-06-01 09:00:00.000", 0), (8, 40, "2024-06-01 09:00:00.000", 0), (8, 40, "2024-06-01 09:00:07.318", 1),
        (None, 50, "2024-06-01 09:00:00.000", 1),
        *[(7, 60, f"2024-06-01 09:00:{i:02d}.000", int(i == 0)) for i in range(32)],
    ]
    return spark.createDataFrame(data, "user_id long, session_id long, timestamp_local string, add_to_cart tinyint")


def test_one_user_in_order(rows):
    got = session_metrics(rows, 9)
    assert got.columns == COLUMNS
    assert [tuple(r) for r in got.collect()] == [(9, 12, 0.0, 100.0), (9, 30, 130.25, 50.0)]


def test_all_known_users(rows):
    got = sorted(tuple(r) for r in session_metrics(rows).collect())
    assert got == [(7, 60, 31.0, 3.12), (8, 40, 7.32, 33.33), (9, 12, 0.0, 100.0), (9, 30, 130.25, 50.0)]


def test_timestamps_need_no_parsing_if_typed(rows):
    typed = rows.withColumn("timestamp_local", F.to_timestamp_ntz("timestamp_local"))
    assert sorted(session_metrics(typed).collect()) == sorted(session_metrics(rows).collect())


def test_unknown_user_gives_typed_empty_frame(rows):
    got = session_metrics(rows, 9_999_999)
    assert got.count() == 0
    assert got.dtypes == [("user_id", "bigint"), ("session_id", "bigint"), ("total_session_time", "double"), ("cart_addition_ratio", "double")]


def test_calendar(spark):
    df = spark.createDataFrame([(f"2024-06-0{d} {h:02d}:30:00",) for d, h in ((2, 5), (3, 6), (3, 12), (3, 18), (3, 23))], "t string")
    got = calendar_features(df.select(F.to_timestamp_ntz("t").alias("timestamp_local")))
    assert [tuple(r)[1:] for r in got.collect()] == [(2, 7, 5, 3), (3, 1, 6, 0), (3, 1, 12, 1), (3, 1, 18, 2), (3, 1, 23, 2)]


def test_fills(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (1, 4.0), (2, None)], "session_id long, x double")
    assert sorted(map(str, (r.x for r in fill_session_max(df, ["x"]).collect()))) == ["2.0", "4.0", "4.0", "None"]
    assert sorted(map(str, (r.x for r in fill_session_mean(df, ["x"]).collect()))) == ["2.0", "3.0", "4.0", "None"]
