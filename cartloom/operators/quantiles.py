"""Exact quantiles without holding all values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.operators.ordered import same_keys, windowed


def cumulative_counts(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    falling: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """One row per (keys, value): `n` rows, and `upto` = rows at or before it in value order.

    Equal values are merged before anything is sorted. Nulls and NaN are no values and left out.
    With `weight`, a row stands for that many rows. Null keys are keys.
    """
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    hist = df.filter(is_value(df, value)).groupBy(*keys, value).agg(rows.alias("n"))
    order = [F.col(value).desc() if falling else F.col(value).asc()]
    return windowed(hist, keys, order, running={"upto": F.col("n")})


def is_value(df: DataFrame, name: str) -> Column:
    """Neither null nor NaN."""
    column = F.col(name)
    return column.isNotNull() & ~F.isnan(column) if dict(df.dtypes)[name] in ("float", "double") else column.isNotNull()


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    *,
    weight: str | None = None,
) -> DataFrame:
    """`keys`, `n`, and `edges`: the linearly interpolated quantiles, in the order asked for."""
    steps = cumulative_counts(df, keys, value, weight=weight)
    steps = steps.withColumn("_v", F.col(value).cast("double"))
    rows = F.sum(F.when(is_value(df, value), F.col(weight))) if weight else F.count_if(is_value(df, value))
    totals = df.groupBy(*keys).agg(rows.alias("_total"))
    joined = same_keys(steps, totals, keys) if keys else steps.withColumn("_total", totals.select("_total").scalar())
    picks: list[Column] = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("_total") - 1)
        picks.append(F.min(F.when(F.col("upto") > F.floor(position), F.col("_v"))).alias(f"_lo{i}"))
        picks.append(F.min(F.when(F.col("upto") > F.ceil(position), F.col("_v"))).alias(f"_hi{i}"))
    found = joined.groupBy(*keys).agg(F.max("_total").alias("n"), *picks)
    edges = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        edges.append(low + (high - low) * (position - F.floor(position)))
    return found.select(*keys, "n", F.array(*edges).alias("edges"))
