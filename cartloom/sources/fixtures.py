"""The three model tables derived from the generic test tables (events, orders, part, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# First day of the held-out split.
TEST_FROM = "2024-01-25"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    home = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    session = (
        F.col("user_id") * 100 + F.floor((F.dayofmonth("ts") - 1) / 3)
    ).cast("bigint")
    return (
        events.withColumn("session_id", session)
        .join(home, F.col("user_id") == F.col("c_custkey"), "left")
        .select(
            F.col("event_id").alias("interaction_id"),
            "session_id",
            F.col("ts").cast("date").alias("date"),
            F.col("ts").alias("timestamp_local"),
            F.when(F.col("session_id") % 4 != 0, F.col("user_id")).alias("user_id"),
            ((F.col("c_nationkey") + F.when(F.col("event_id") % 6 == 0, 1).otherwise(0)) % 25)
            .cast("smallint").alias("country"),
            F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("partnumber"),
            (F.col("session_id") % 3 + 1).cast("smallint").alias("device_type"),
            F.when(F.col("event_id") % 50 != 0, F.col("event_id") % 5 + 1)
            .cast("smallint").alias("pagetype"),
            (F.col("event_type") == "purchase").cast("tinyint").alias("add_to_cart"),
        )
    )


def train(spark: SparkSession, folder: str) -> DataFrame:
    return interactions(spark, folder).filter(F.col("date") < F.lit(TEST_FROM).cast("date"))


def test(spark: SparkSession, folder: str) -> DataFrame:
    late = interactions(spark, folder).filter(F.col("date") >= F.lit(TEST_FROM).cast("date"))
    return late.drop("add_to_cart")


def users(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderdate",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )
    entries = orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.max("o_orderdate").alias("last"), F.count(F.lit(1)).alias("F"), F.sum("price").alias("M")
    )
    home = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return entries.join(home, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("user_id"),
        ((F.col("c_nationkey") + F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)) % 25)
        .cast("smallint").alias("country"),
        F.date_diff(F.lit("2001-08-02").cast("date"), F.col("last").cast("date")).alias("R"),
        F.col("F").cast("int").alias("F"),
        F.col("M").cast("double").alias("M"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return part.join(vectors, F.col("p_partkey") == F.col("vec_id"), "left").select(
        F.col("p_partkey").cast("int").alias("partnumber"),
        F.regexp_extract("p_brand", "[0-9]+", 0).cast("int").alias("family"),
        (F.col("p_size") % 10).alias("color_id"),
        F.when(F.col("p_partkey") % 9 != 0, F.col("p_type")).alias("cod_section"),
        (F.col("p_partkey") % 4 == 0).cast("tinyint").alias("discount"),
        F.when(F.col("p_partkey") % 8 != 3, F.col("embedding")).alias("embedding"),
    )
