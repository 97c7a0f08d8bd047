"""Readers, writers and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from cartloom import schemas
from cartloom.operators.sessions import session_metrics
from cartloom.sources import fixtures, readers, writers
from cartloom.streaming import sessions as ST


def test_csv_and_parquet(spark, small, tmp_path):
    train = fixtures.train(spark, small).drop("interaction_id")
    # Whole numbers with gaps come as 24.0 out of data frames.
    text = train.withColumn("user_id", F.col("user_id").cast("double"))
    text.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(str(tmp_path / "csv"))
    back = readers.load_data(spark, str(tmp_path / "csv"), schemas.INTERACTIONS)
    assert back.schema.names == schemas.INTERACTIONS.names
    assert back.exceptAll(readers.cast_interactions(train)).count() == 0 and back.count() == train.count()
    writers.write_table(back, str(tmp_path / "pq"))
    cols = readers.load_data(spark, str(tmp_path / "pq"), file_type="parquet", select_cols=["session_id"], n_rows=10)
    assert cols.columns == ["session_id"] and cols.count() == 10


def test_unknown_type_is_refused(spark):
    with pytest.raises(ValueError):
        readers.load_data(spark, "x", file_type="pickle")


def test_user_records(spark, tmp_path):
    lines = [
        {"user_id": "8801", "values": {"country": [14, 7], "R": [33, 33], "F": [52, 3], "M": [71.5, 2.0]}},
        {"user_id": "9", "values": {"country": [1, 2, 3], "R": [30, 10, 20], "F": [1, 2, 3], "M": [1.0, 2.0, 3.0]}},
    ]
    (tmp_path / "u.json").write_text("\n".join(map(json.dumps, lines)))
    records = readers.read_user_records(spark, str(tmp_path / "u.json"))
    rows = readers.user_rows(records)
    assert rows.count() == 5 and rows.drop("entry").schema.names == schemas.USERS.names
    recent = {(r.user_id, r.country, r.R) for r in readers.recent_user_rows(records).collect()}
    assert recent == {(8801, 14, 33), (9, 2, 10)}
    for i in range(2):
        writers.write_table(rows.drop("entry").withColumn("user_id", F.col("user_id") + i), str(tmp_path / "b" / f"batch={i}"))
    assert readers.merge_batches(spark, str(tmp_path / "b" / "*")).count() == 10


def test_casts_refuse_what_does_not_fit(spark, small):
    wide = fixtures.train(spark, small).withColumn("country", F.lit(300))
    with pytest.raises(Exception, match="country out of range"):
        readers.cast_interactions(wide).collect()
    test = readers.cast_interactions(fixtures.test(spark, small), train=False)
    assert "add_to_cart" not in test.columns


def test_products_header(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "partnumber int, familiy int")
    df.write.parquet(str(tmp_path / "p"))
    assert readers.read_products(spark, str(tmp_path / "p")).columns == ["partnumber", "family"]


def test_json_sinks(spark, tmp_path):
    lists = spark.createDataFrame([(31, [77, 42]), (95, [5])], "session_id long, items array<int>")
    writers.write_recommendations(lists, str(tmp_path / "r"))
    got = {}
    for row in spark.read.text(str(tmp_path / "r")).collect():
        got.update(json.loads(row.value)["target"])
    assert got == {"31": [77, 42], "95": [5]}
    answers = {
        "query_1": spark.createDataFrame([(4400,)], "partnumber int"),
        "query_7": spark.createDataFrame([(1, 13), (2, 6)], "family int, pagetype int"),
    }
    writers.write_answers(answers, str(tmp_path / "a"))
    got = {}
    for row in spark.read.text(str(tmp_path / "a")).collect():
        got.update(json.loads(row.value)["target"])
    assert got == {"query_1": {"partnumber": 4400}, "query_7": {"1": 13, "2": 6}}


def test_csv_keeps_large_ids_and_refuses_fractions(spark, tmp_path):
    schema = schemas.T.StructType([schemas.T.StructField("id", schemas.T.LongType()), schemas.T.StructField("n", schemas.T.IntegerType())])
    (tmp_path / "a.csv").write_text("n,id\n24.0,9007199254740993\n,4000000001\n")
    rows = readers.load_data(spark, str(tmp_path / "a.csv"), schema).collect()
    assert [tuple(r) for r in rows] == [(9007199254740993, 24), (4000000001, None)]
    (tmp_path / "b.csv").write_text("n,id\n24.7,1\n")
    with pytest.raises(Exception, match="no whole number"):
        readers.load_data(spark, str(tmp_path / "b.csv"), schema).collect()


def test_products_projection_by_the_right_name(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "partnumber int, familiy int").write.parquet(str(tmp_path / "p"))
    assert readers.read_products(spark, str(tmp_path / "p"), select_cols=["family"]).collect()[0][0] == 2


def test_stream_equals_batch(spark, small, tmp_path):
    rows = readers.cast_interactions(fixtures.interactions(spark, small)).drop("interaction_id")
    # A row far ahead in time closes all sessions before it.
    last = rows.limit(1).withColumns({"timestamp_local": F.lit("2030-01-01").cast("timestamp_ntz"), "user_id": F.lit(1).cast("bigint"), "session_id": F.lit(-5).cast("bigint")})
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    last.select(*[F.col(n).cast(k) for n, k in rows.dtypes]).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ST.session_metrics_stream(ST.read_interaction_stream(spark, str(tmp_path / "in"), 1), late="60 days", longest="36500 days")
    query = (
        stream.writeStream.outputMode("update").format("memory").queryName("metrics")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    # In update mode a session comes once per batch that changes it; the last one has all its rows.
    best = spark.table("metrics").filter("session_id >= 0").groupBy("user_id", "session_id").agg(F.max("total_session_time").alias("t")).orderBy("user_id", "session_id")
    want = session_metrics(rows).orderBy("user_id", "session_id").select("user_id", "session_id", F.col("total_session_time").alias("t"))
    assert best.collect() == want.collect()
