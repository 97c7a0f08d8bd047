"""Shards of equal row counts in random order, by a two-pass external shuffle in DataFrame functions only.

Pass one scatters rows over buckets that fit in memory: the bucket is a seeded hash of the row, and the scattered rows
are written to the shared folder with it. Pass two reads them bucket by bucket, puts each bucket's rows in the
order of a Fisher-Yates shuffle (Spark's `shuffle` of the bucket's rows, which are sorted by hash before) and writes them. A
bucket's first place follows from the counts of the buckets before it, so the buckets one after another are one random order
of all rows, which is cut into shards whose counts differ by one at most.

Rows that are repeated have the same hash. Those with more than one in `hot_share` of all rows, fewer than `hot_share` hashes, get a
number as salt, so they spread over all buckets, too. Which of several equal rows takes which place makes no difference.

Cases: all columns of the table are kept, whatever their names, in the struct `record`; columns of type map can't be hashed
and have to be turned into arrays before. Null texts and empty ones are rows like others. A row larger than a bucket makes that
bucket larger. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.session import new_path, stage


@dataclass(frozen=True)
class Settings:
    """bucket_bytes: what a task holds and shuffles at once; hot_share: see the module's head."""

    shards: int = 16
    bucket_bytes: int = 12 << 20
    hot_share: int = 4096
    seed: int = 17


# What a row takes besides its strings.
ROW_BYTES = 64


def _row_bytes(rows: DataFrame) -> Column:
    strings = [c for c, kind in rows.dtypes if kind in ("string", "binary")]
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`")).cast("bigint"), F.lit(0)) for c in strings]
    return sum(sizes, F.lit(ROW_BYTES).cast("bigint"))


def scatter(rows: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, int, int]:
    """Pass one: (bucket, key, salt, record), written; the number of rows and of buckets."""
    columns = [F.col(f"`{c}`") for c in rows.columns]
    hashed = F.xxhash64(F.lit(settings.seed), *columns)
    counts = rows.select(hashed.alias("key"), _row_bytes(rows).alias("bytes")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")
    )
    counts = stage(counts, "sharding-keys")
    total, size = counts.agg(F.sum("n"), F.sum("bytes")).first()
    total, buckets = total or 0, max(1, math.ceil((size or 0) / settings.bucket_bytes))
    # Fewer than `hot_share` keys by their definition.
    hot = counts.filter(F.col("n") * settings.hot_share > total).filter("n > 1").select(F.col("key").alias("hot_key"))
    keyed = rows.select(hashed.alias("key"), F.struct(*columns).alias("record"))
    salted = keyed.join(F.broadcast(hot), F.col("key") == F.col("hot_key"), "left").select(
        "key", F.when(F.col("hot_key").isNull(), F.lit(0)).otherwise(F.monotonically_increasing_id()).cast("bigint").alias("salt"), "record"
    )
    bucket = F.pmod(F.xxhash64(F.lit(settings.seed + 1), "key", "salt"), F.lit(buckets)).cast("int")
    return stage(salted.select(bucket.alias("bucket"), "key", "salt", "record"), "sharding-scattered"), total, buckets


def _starts(scattered: DataFrame) -> DataFrame:
    """(bucket, start): rows in the buckets before. Summed in two steps, so that no task has all buckets."""
    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.shiftright("bucket", 12))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("block").agg(F.sum("n").alias("n")).select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("blocks_before"))
    inside = Window.partitionBy("block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return placed.join(blocks, "block").select("bucket", (F.col("blocks_before") + F.col("inside")).alias("start"))


def ordered(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Pass two, not yet written: (shard, slot, record)."""
    scattered, total, buckets = scatter(rows, settings)
    dealt = scattered.repartition(buckets, "bucket").join(_starts(scattered).hint("shuffle_merge"), "bucket")
    whole = dealt.groupBy("bucket").agg(
        F.max("start").alias("start"), F.sort_array(F.collect_list(F.struct("key", "salt", "record"))).alias("rows")
    )
    # Sorted, so that the generator's numbers meet the buckets of a task in the same order every time.
    mixed = whole.sortWithinPartitions("bucket").select("start", F.shuffle("rows.record", settings.seed).alias("records"))
    each = mixed.select("start", F.posexplode("records").alias("place", "record")).withColumn("place", F.col("start") + F.col("place"))
    shard = F.expr(f"(place * {settings.shards}L) div {max(1, total)}L")
    first = F.expr(f"(shard * {total}L + {settings.shards - 1}L) div {settings.shards}L")
    return each.withColumn("shard", shard).select(F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot"), "record")


def write_shards(rows: DataFrame, path: str, settings: Settings = Settings()) -> None:
    """One folder per shard; `slot` is a row's place in its shard."""
    ordered(rows, settings).write.option("compression", "zstd").partitionBy("shard").parquet(path)


def report(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Where every document lies, read back from the written shards."""
    path = new_path(docs.sparkSession, "shards")
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    write_shards(slim, path, settings)
    record = dict(slim.dtypes)
    schema = f"slot bigint, record struct<doc_id:{record['doc_id']},text:string>, shard int"
    text = F.coalesce("record.text", F.lit(""))
    return docs.sparkSession.read.schema(schema).parquet(path).select(
        F.col("record.doc_id").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
