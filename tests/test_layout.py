"""Tables bucketed by session: same rows, and no exchange between operators on sessions."""

import pytest
from pyspark.sql import functions as F

from cartloom.operators import evaluate as E, sessions as S
from cartloom.sources import fixtures, writers

STEPS = {
    "size": S.session_size,
    "max": lambda t: S.fill_session_max(t, ["user_id"]),
    "mean": lambda t: S.fill_session_mean(t, ["user_id"]),
    "metrics": S.session_metrics,
    "ndcg": lambda t: E.session_ndcg(t.withColumn("score", F.col("partnumber") % 7)),
    "size, then max": lambda t: S.fill_session_max(S.session_size(t), ["user_id"]),
}


@pytest.fixture(scope="module")
def pair(spark, small, tmp_path_factory):
    train = fixtures.train(spark, small).cache()
    path = str(tmp_path_factory.mktemp("layout") / "train")
    table = writers.write_bucketed(train, "train_by_session", path, order=["timestamp_local", "interaction_id"], buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield train, table
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.sql("DROP TABLE train_by_session")


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("name", STEPS)
def test_no_exchange_and_same_rows(pair, name):
    train, table = pair
    plain, laid_out = STEPS[name](train), STEPS[name](table)
    assert exchanges(plain) > 0 and exchanges(laid_out) == 0
    assert plain.exceptAll(laid_out.select(plain.columns)).count() == laid_out.select(plain.columns).exceptAll(plain).count() == 0


def test_rows_are_all_there(pair):
    train, table = pair
    assert table.count() == train.count() and train.exceptAll(table.select(train.columns)).count() == 0


def test_empty_table(spark, pair, tmp_path):
    train, _ = pair
    none = writers.write_bucketed(train.filter("session_id < 0"), "train_empty", str(tmp_path / "none"), buckets=4)
    assert S.session_size(none).count() == 0
    spark.sql("DROP TABLE train_empty")
