"""Distinct counts and overlaps from theta sketches: small tables that can be kept by day or file and merged later.

A sketch holds at most 2^LOG_ENTRIES hashes (32 kB), whatever the data; a column with fewer different values is counted
exactly. Every task sketches its own rows, so no value is shuffled. A null counts as a value.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_ENTRIES = 12
#: An estimate of a union lies within so many standard errors of the truth but for about one in 16,000 cases.
DEVIATIONS = 4


def relative_bound(log_entries: int = LOG_ENTRIES) -> float:
    """Bound on the relative error of a distinct count."""
    return DEVIATIONS / sqrt(2**log_entries - 1)


def _value(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("v"), F.col(column).cast("string")), F.lit("n"))


def column_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), log_entries: int = LOG_ENTRIES) -> DataFrame:
    """(by..., column_name, sketch): one row per column, and per group of `by` if given. All columns in one pass."""
    row = df.groupBy(*by).agg(*[F.theta_sketch_agg(_value(c), log_entries).alias(f"_s_{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_s_{i}").alias("sketch")) for i, c in enumerate(columns)])
    return row.select(*by, F.explode(pairs).alias("_p")).select(*by, "_p.*")


def merged(sketches: DataFrame, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """(column_name, sketch) of all rows that any of the sketches saw."""
    return sketches.groupBy("column_name").agg(F.theta_union_agg("sketch", log_entries).alias("sketch"))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """(column_name, estimate): about how many different values each column has."""
    return sketches.select("column_name", F.theta_sketch_estimate("sketch").alias("estimate"))


def overlap_estimates(train: DataFrame, test: DataFrame, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """(column_name, common, train_only, test_only, either) from the sketches of two splits.

    The error of the first three is bounded against `either`: relative_bound() * either.
    """
    pairs = train.join(test.withColumnRenamed("sketch", "_other"), "column_name")
    return pairs.select(
        "column_name",
        F.theta_sketch_estimate(F.theta_intersection("sketch", "_other")).alias("common"),
        F.theta_sketch_estimate(F.theta_difference("sketch", "_other")).alias("train_only"),
        F.theta_sketch_estimate(F.theta_difference("_other", "sketch")).alias("test_only"),
        F.theta_sketch_estimate(F.theta_union("sketch", "_other", log_entries)).alias("either"),
    )
