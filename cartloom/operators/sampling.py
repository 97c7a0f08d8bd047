"""Exact, repeatable sampling of a given number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.functions.hashing import draw, draw_slot
from cartloom.operators.ordered import PART, dealt


def draw_rows(df: DataFrame, key: Sequence[str], wanted: Column, seed: int) -> DataFrame:
    """The `wanted` rows with the smallest seeded draw over the unique `key`.

    Rows are counted in 65,536 draw slots. All slots below the one where the count is reached are
    kept whole; only that one slot is ranked. No global sort, no row passes through one task.
    """
    drawn = df.withColumn("_draw", draw(*key, seed=seed)).withColumn("_slot", draw_slot(F.col("_draw")))
    filled = drawn.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n"))
    along = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # At most 65,536 rows by construction of the slot.
    slots = filled.withColumn("_upto", F.sum("_n").over(along)).withColumn("_wanted", wanted)
    slots = slots.filter(F.col("_upto") - F.col("_n") < F.col("_wanted"))
    near = drawn.join(F.broadcast(slots), "_slot")
    full = near.filter(F.col("_upto") <= F.col("_wanted"))
    inside = Window.partitionBy("_slot").orderBy("_draw", *key)
    last = (
        near.filter(F.col("_upto") > F.col("_wanted"))
        .withColumn("_rank", F.row_number().over(inside))
        .filter(F.col("_rank") <= F.col("_wanted") - F.col("_upto") + F.col("_n"))
    )
    return full.select(*df.columns).unionByName(last.select(*df.columns))


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 23) -> DataFrame:
    """`n` random rows (all, if there are fewer)."""
    return draw_rows(df, key, F.lit(n), seed)


def first_rows(df: DataFrame, n: int = 1_000_000, order: Sequence[str] = ()) -> DataFrame:
    """The loader's row cap: the first `n` rows, in `order` if one is given (it should end in a unique column).

    With an order, rows are dealt out by range of it and counted; ranges below the one where the count is reached are
    kept whole and only that one is ranked. Without one, the scan stops as soon as it has `n` rows.
    """
    if not order:
        return df.limit(n)
    rows = dealt(df, order, [])
    along = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per range.
    counts = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
    places = F.broadcast(counts.withColumn("_before", F.sum("_n").over(along) - F.col("_n")).filter(F.col("_before") < n))
    near = rows.join(places, PART)
    full = near.filter(F.col("_before") + F.col("_n") <= n)
    rank = F.row_number().over(Window.partitionBy(PART).orderBy(*order))
    last = near.filter(F.col("_before") + F.col("_n") > n).withColumn("_rank", rank).filter(F.col("_rank") <= n - F.col("_before"))
    return full.select(*df.columns).unionByName(last.select(*df.columns))
