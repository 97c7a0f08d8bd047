import zlib

import pytest

from cartloom.llm import sharding
from cartloom.session import new_path

from . import cases


def checked(spark, frame, settings):
    """The written shards hold every row once, gapless, with counts one apart."""
    path = new_path(spark, "shards")
    sharding.write_shards(frame, path, settings)
    rows = spark.read.schema(f"slot bigint, record {frame.select(__import__('pyspark').sql.functions.struct('*').alias('r')).schema['r'].dataType.simpleString()}, shard int").parquet(path).collect()
    assert sorted((tuple(r["record"]) for r in rows), key=str) == sorted((tuple(r) for r in frame.collect()), key=str)
    places = {}
    for r in rows:
        places.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    sizes = [len(places.get(s, [])) for s in range(settings.shards)]
    assert max(sizes) - min(sizes) <= 1 and set(places) <= set(range(settings.shards))
    return rows


def test_odd_and_repeated_rows(spark):
    frame = cases.odd_documents(spark)
    checked(spark, frame, sharding.Settings(bucket_bytes=2000))
    copies = spark.createDataFrame([(1, "same")] * 700 + [(i, f"text {i}") for i in range(900)], "doc_id bigint, text string")
    small = sharding.Settings(shards=7, bucket_bytes=1000, hot_share=64)
    checked(spark, copies, small)
    scattered, total, buckets = sharding.scatter(copies, small)
    sizes = [r["count"] for r in scattered.groupBy("bucket").count().collect()]
    assert total == 1600 and buckets > 50 and max(sizes) < 60


def test_order_is_random_and_repeatable(spark):
    frame = spark.range(4000).selectExpr("id AS doc_id", "cast(id AS string) AS text", "'x' AS shard", "1 AS slot")
    settings = sharding.Settings(bucket_bytes=9000)
    rows = checked(spark, frame, settings)
    place = {r["record"]["doc_id"]: r["shard"] * 250 + r["slot"] for r in rows}
    again = {r["record"]["doc_id"]: r["shard"] * 250 + r["slot"] for r in checked(spark, frame.repartition(5), settings)}
    assert place == again
    other = {r["record"]["doc_id"]: r["shard"] * 250 + r["slot"] for r in checked(spark, frame, sharding.Settings(bucket_bytes=9000, seed=18))}
    assert sum(place[i] == other[i] for i in place) < 40
    # Of a random order, ids and places are uncorrelated, and each 250 neighbours are spread over all shards.
    mean = 1999.5
    correlation = sum((i - mean) * (p - mean) for i, p in place.items()) / sum((i - mean) ** 2 for i in place)
    assert abs(correlation) < 0.08
    assert all(len({place[i] // 250 for i in range(a, a + 250)}) == 16 for a in range(0, 4000, 250))


def test_report_equals_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = sharding.report(docs).collect()
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {(i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in text.items()}
    assert len(rows) == len(text) and {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


@pytest.mark.parametrize("shards", [1, 16])
def test_empty_and_tiny(spark, shards):
    settings = sharding.Settings(shards=shards)
    empty = cases.empty_documents(spark)
    assert sharding.ordered(empty, settings).count() == 0
    assert sharding.report(empty).count() == 0
    checked(spark, spark.createDataFrame([(1, None), (None, None), (None, "")], "doc_id bigint, text string"), settings)
