"""Writing tables, answers and recommendations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_bucketed(
    df: DataFrame, table: str, path: str, keys: Sequence[str] = ("session_id",), order: Sequence[str] = (), buckets: int = 64
) -> DataFrame:
    """A table in `path`, dealt into buckets by `keys` and sorted in each; returns it as it is read back.

    Operators that group or join by `keys`, and joins between tables of as many buckets, then need no exchange. A
    layout for keys of moderate groups, such as sessions: all rows of a key lie in one bucket. For hot keys,
    `ordered.windowed` deals rows out by range and needs no such table.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.format("parquet").option("compression", "zstd").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys, *order).saveAsTable(table)
    return df.sparkSession.table(table)


def recommendation_json(lists: DataFrame) -> DataFrame:
    """(session_id, items) -> one JSON text per session: {"target": {"<session>": [ids]}}."""
    target = F.struct(F.create_map(F.col("session_id").cast("string"), F.col("items")).alias("target"))
    return lists.select(F.to_json(target).alias("value"))


def write_recommendations(lists: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, written by all tasks; no task or driver holds the whole target."""
    recommendation_json(lists).write.mode(mode).text(path)


def answer_rows(answers: dict[str, DataFrame]) -> DataFrame:
    """Answer frames -> (query, key, value): one row per answer column, or per row of a 2-column map.

    Values are written out as numbers, so that whole numbers stay whole.
    """
    parts = []
    for query, frame in answers.items():
        if len(frame.columns) == 2:
            key, value = frame.columns
            part = frame.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))
        else:
            name = frame.columns[0]
            part = frame.select(F.lit(name).alias("key"), F.col(name).cast("string").alias("value"))
        parts.append(part.select(F.lit(query).alias("query"), "key", "value"))
    return reduce(DataFrame.unionByName, parts)


def answer_json(answers: dict[str, DataFrame]) -> DataFrame:
    """One JSON text {"target": {query: {key: value}}} per query.

    An answer is a single value or has one entry per family, so one query is one small map.
    """
    rows = answer_rows(answers).filter(F.col("key").isNotNull())
    per = rows.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("key", "value"))).alias("_entries"))
    # Numbers of different kinds in one object: put together as text, names and family numbers need no escapes.
    inside = F.array_join(F.transform("_entries", lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), F.coalesce(e["value"], F.lit("null")))), ",")
    return per.select(F.concat(F.lit('{"target":{"'), F.col("query"), F.lit('":{'), inside, F.lit("}}}")).alias("value"))


def write_answers(answers: dict[str, DataFrame], path: str, mode: str = "errorifexists") -> None:
    answer_json(answers).write.mode(mode).text(path)
