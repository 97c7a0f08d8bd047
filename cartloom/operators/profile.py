"""Profiling of tables and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.operators.quantiles import exact_quantiles


def _long(row: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    """One row with one column per name -> one row per name."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(n).cast("bigint").alias(value)) for n in names
    ]))
    return row.select(pairs.alias("_p")).select("_p.*")


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls)."""
    return _long(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]), df.columns, "nulls")


def distinct_counts(df: DataFrame) -> DataFrame:
    """(column_name, distinct_values): exact, null counts as a value.

    Each row gives one text per column, and equal (column, value) pairs merge before the shuffle.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns
    ]))
    different = df.select(pairs.alias("_p")).select("_p.*").distinct()
    return different.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))


def split_overview(train: DataFrame, test: DataFrame) -> DataFrame:
    """Sessions, products and date range of each split."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count_distinct("session_id").alias("sessions"),
            F.count_distinct("partnumber").alias("products"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        ).select(F.lit(name).alias("split"), "*")

    return one(train, "train").unionByName(one(test, "test"))


def common_keys(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    return train.select(column).intersect(test.select(column))


def test_only_keys(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    return test.select(column).subtract(train.select(column))


def key_overlap(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    """Every value of `column` with where it occurs: both, train or test. Null counts as a value."""
    sides = train.select(column, F.lit(1).alias("_side")).unionByName(test.select(column, F.lit(2).alias("_side")))
    where = sides.groupBy(column).agg(F.bit_or("_side").alias("_sides"))
    return where.select(
        column, F.when(F.col("_sides") == 3, "both").when(F.col("_sides") == 1, "train").otherwise("test").alias("found_in")
    )


def long_sessions(df: DataFrame, n: int) -> DataFrame:
    """Sessions with at least n rows, rows with a null in any column left out."""
    sizes = df.na.drop("any").groupBy("session_id").agg(F.count("user_id").alias("rows"))
    return sizes.filter(F.col("rows") >= n)


def label_distribution(df: DataFrame, label: str = "add_to_cart") -> DataFrame:
    """Rows and share of each label value, and negatives per positive."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(
        F.struct(
            F.sum("rows").alias("all"),
            F.sum(F.when(F.col(label) == 0, F.col("rows"))).alias("negative"),
            F.sum(F.when(F.col(label) == 1, F.col("rows"))).alias("positive"),
        ).alias("_t")
    ).scalar()
    return counts.withColumn("_t", total).select(
        label, "rows",
        (F.col("rows") / F.col("_t.all")).alias("share"),
        F.try_divide(F.col("_t.negative"), F.col("_t.positive")).alias("negative_ratio"),
    )


def popularity_histogram(counts: DataFrame, above: float, bins: int = 100, value: str = "score") -> DataFrame:
    """(bin, low, high, n): equal-width bins between the smallest and largest value above a floor.

    The last bin includes its upper edge; empty bins are listed.
    """
    kept = counts.filter(F.col(value) > above)
    span = kept.agg(F.struct(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")).alias("_s"))
    lo, hi = F.col("_s.lo"), F.col("_s.hi")
    place = F.floor(F.coalesce(F.try_divide(F.col(value) - lo, hi - lo), F.lit(0.0)) * bins)
    filled = (
        kept.withColumn("_s", span.scalar())
        .withColumn("bin", F.least(place, F.lit(bins - 1)))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    frame = span.select("_s", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(filled, "bin", "left").select(
        "bin",
        (lo + (hi - lo) * F.col("bin") / bins).alias("low"),
        (lo + (hi - lo) * (F.col("bin") + 1) / bins).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def users_per_session(df: DataFrame) -> DataFrame:
    """(users, sessions): how many sessions have how many different users (rows without nulls)."""
    per = df.na.drop("any").groupBy("session_id").agg(F.count_distinct("user_id").alias("users"))
    return per.groupBy("users").agg(F.count(F.lit(1)).alias("sessions"))


NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_summary(df: DataFrame) -> DataFrame:
    """Count, mean, standard deviation, minimum, exact quartiles and maximum per numeric column, without nulls and NaN."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMBERS)]
    pairs = F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(n).cast("double").alias("value")) for n in names
    ]))
    values = df.select(pairs.alias("_p")).select("_p.*").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    basic = values.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    cut = exact_quantiles(values, ["column_name"], "value", (0.25, 0.5, 0.75)).drop("n")
    return basic.join(cut, "column_name").select(
        "column_name", "count", "mean", "std", "min",
        F.col("edges")[0].alias("q25"), F.col("edges")[1].alias("q50"), F.col("edges")[2].alias("q75"), "max",
    )
