"""Ordered windows that survive a key holding a large share of all rows.

A plain window puts all rows of one key into one task. Here rows are dealt out by range of (key, order)
and written once with the number of their partition. Windows run inside (key, partition), so a task
never gets more than one partition's rows, however large a key or however equal its times. A key
that lies in several partitions is the last key of one and the first of the next; for those keys alone,
at most two rows per partition, sums and neighbours are carried over. There is one path for all keys:
no threshold, no count of rows per key, and nulls are values like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.session import stage

PART = "_part"


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same name; nulls are equal to each other."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, condition, how).drop(*[f"_r_{k}" for k in keys])


def dealt(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """`df` by range of keys and order, written once, with PART: partition numbers rise along the order."""
    ranged = df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], *order)
    return stage(ranged.withColumn(PART, F.spark_partition_id()), "ordered")


def crossing_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of `dealt` rows that lie in more than one partition: at most one per border between two."""
    key = F.struct(*keys)
    ends = rows.groupBy(PART).agg(F.array_distinct(F.array(F.min(key), F.max(key))).alias("_ends"))
    each = ends.select(PART, F.explode("_ends").alias("_key"))
    return each.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_key.*")


def windowed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    running: Mapping[str, Column] | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    overall: Mapping[str, tuple[str, str | Column]] | None = None,
    position: Sequence[str] = (),
) -> DataFrame:
    """Window columns over `keys` in `order`, which should end in a unique column.

    running     name -> non-null number: sum from the start to the current row
    previous    name -> column: value of the row before
    following   name -> column: value of the row after
    overall     name -> (min | max | sum | count, column): over the whole key
    position    names of the ascending columns that make up `order`, needed for previous/following
    """
    running, previous = dict(running or {}), dict(previous or {})
    following, overall = dict(following or {}), dict(overall or {})
    keys = list(keys)
    rows = dealt(df, keys, order)

    local = Window.partitionBy(*keys, PART).orderBy(*order)
    so_far = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = local.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    columns: dict[str, Column] = {}
    for out, value in running.items():
        columns[out] = F.sum(value).over(so_far)
    for out, value in previous.items():
        columns[out] = F.lag(value).over(local)
    for out, value in following.items():
        columns[out] = F.lead(value).over(local)
    for out, (how, value) in overall.items():
        columns[out] = getattr(F, how)(value).over(whole)
    marks: dict[str, Column] = {}
    if previous:
        marks["_is_first"] = F.lag(F.lit(True)).over(local).isNull()
    if following:
        marks["_is_last"] = F.lead(F.lit(True)).over(local).isNull()
    inside = rows.withColumns({**columns, **marks})

    # One row per partition of a key that crosses a border.
    border = F.broadcast(crossing_keys(rows, keys))
    place = F.struct(*position) if position else None
    pieces: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for out, value in running.items():
        pieces.append(F.sum(value).alias(f"_r_{out}"))
    for out, value in previous.items():
        pieces.append(F.max_by(value, place).alias(f"_p_{out}"))
    for out, value in following.items():
        pieces.append(F.min_by(value, place).alias(f"_f_{out}"))
    for out, (how, value) in overall.items():
        pieces.append(getattr(F, how)(value).alias(f"_o_{out}"))
    summary = same_keys(rows, border, keys, "left_semi").groupBy(*keys, PART).agg(*pieces)

    along = Window.partitionBy(*keys).orderBy(PART)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    entire = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried: list[Column] = [F.lit(True).alias("_crosses")]
    final: dict[str, Column] = {}
    for out in running:
        carried.append(F.sum(f"_r_{out}").over(before).alias(f"_c_{out}"))
        final[out] = F.col(out) + F.coalesce(F.col(f"_c_{out}"), F.lit(0))
    for out in previous:
        carried.append(F.lag(f"_p_{out}").over(along).alias(f"_c_{out}"))
        final[out] = F.when(F.col("_is_first"), F.col(f"_c_{out}")).otherwise(F.col(out))
    for out in following:
        carried.append(F.lead(f"_f_{out}").over(along).alias(f"_c_{out}"))
        final[out] = F.when(F.col("_is_last"), F.col(f"_c_{out}")).otherwise(F.col(out))
    for out, (how, _) in overall.items():
        merge = F.sum if how in ("sum", "count") else getattr(F, how)
        carried.append(merge(f"_o_{out}").over(entire).alias(f"_c_{out}"))
        final[out] = F.when(F.col("_crosses"), F.col(f"_c_{out}")).otherwise(F.col(out))
    offsets = summary.select(*keys, PART, *carried)

    # Two rows per partition at most, hence the hint.
    joined = same_keys(inside, F.broadcast(offsets), [*keys, PART], "left")
    return joined.withColumns(final).select(*df.columns, *columns)
