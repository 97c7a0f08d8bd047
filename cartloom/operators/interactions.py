"""Features of interaction rows that need both splits or whole-table statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.operators.ordered import windowed

ANONYMOUS = -1


def most_frequent(df: DataFrame, column: str) -> Column:
    """Most frequent non-null value of the table (smallest on a tie), as a scalar column."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.max_by(column, F.struct("_n", -F.col(column))).alias("_top")).scalar()


def impute_interactions(df: DataFrame) -> DataFrame:
    """Drop `date`; `known_user` 1/-1; null user -> -1; null page type -> the split's mode."""
    return df.drop("date").withColumns({
        "known_user": F.when(F.col("user_id").isNull(), F.lit(-1)).otherwise(F.lit(1)).cast("tinyint"),
        "user_id": F.coalesce(F.col("user_id"), F.lit(ANONYMOUS)),
        "pagetype": F.coalesce(F.col("pagetype"), most_frequent(df, "pagetype")),
    })


RATIO_KEYS = {
    "pagetype": "page_cart_ratio",
    "device_type": "device_cart_ratio",
    "country": "country_cart_ratio",
}


def cart_ratio_tables(train: DataFrame) -> dict[str, DataFrame]:
    """Mean of `add_to_cart` per page type, device and country, from one pass over train.

    The keys are smallints: each table has at most 65,536 rows.
    """
    keys = [F.col(k).cast("smallint").alias(k) for k in RATIO_KEYS]
    cells = train.groupBy(*keys).agg(
        F.sum(F.col("add_to_cart").cast("bigint")).alias("_adds"), F.count("add_to_cart").alias("_rows")
    )
    return {
        key: cells.groupBy(key).agg(F.try_divide(F.sum("_adds"), F.sum("_rows")).cast("double").alias(name))
        for key, name in RATIO_KEYS.items()
    }


def with_cart_ratios(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Attach the three ratios; a page type train does not have gets -1, other unseen keys null."""
    for key, ratios in tables.items():
        df = df.join(F.broadcast(ratios), key, "left")
    return df.withColumn("page_cart_ratio", F.coalesce("page_cart_ratio", F.lit(-1.0)))


def cart_ratios(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    tables = cart_ratio_tables(train)
    return with_cart_ratios(train, tables), with_cart_ratios(test, tables)


def join_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """Train and test as one frame: `flag` 1/0, the label of test is null."""
    return train.withColumn("flag", F.lit(1).cast("tinyint")).unionByName(
        test.withColumn("flag", F.lit(0).cast("tinyint")), allowMissingColumns=True
    )


def running_counts(
    both: DataFrame,
    *,
    strict_prior: bool = False,
    carry_forward: bool = False,
) -> DataFrame:
    """Running cart additions and interactions of each user, train before test, by time.

    The current row is included unless `strict_prior`. Rows without a label show 0 additions,
    or the user's total so far with `carry_forward`. Anonymous rows (-1) get -1.
    """
    known = F.col("user_id") != ANONYMOUS
    label = F.coalesce(F.col("add_to_cart").cast("bigint"), F.lit(0).cast("bigint"))
    out = windowed(
        both, ["user_id"], [F.col("flag").desc(), F.col("timestamp_local"), F.col("interaction_id")],
        running={"_adds": label, "_rows": F.lit(1)},
    )
    adds, rows = F.col("_adds"), F.col("_rows")
    if strict_prior:
        adds, rows = adds - label, rows - 1
    if not carry_forward:
        adds = F.when(F.col("add_to_cart").isNull(), F.lit(0)).otherwise(adds)
    return out.withColumns({
        "user_previous_cart_additions": F.when(known, adds).otherwise(F.lit(-1)).cast("bigint"),
        "user_previous_interactions": F.when(known, rows).otherwise(F.lit(-1)).cast("bigint"),
    }).drop("_adds", "_rows")


def user_running_counts(train: DataFrame, test: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """`running_counts` over both splits, split back by the flag."""
    both = running_counts(join_splits(train, test), **options)
    return (
        both.filter(F.col("flag") == 1).drop("flag"),
        both.filter(F.col("flag") == 0).drop("flag", "add_to_cart"),
    )


# Columns whose nulls the frame-wide zero fill of the row features turns into 0.
ZERO_FILLED = (
    "device_cart_ratio", "country_cart_ratio", "page_cart_ratio",
    "user_previous_cart_additions", "user_previous_interactions",
)


def fill_zero(df: DataFrame) -> DataFrame:
    return df.na.fill(0, [c for c in ZERO_FILLED if c in df.columns])


def assemble_features(rows: DataFrame, products: DataFrame, users: DataFrame) -> DataFrame:
    """Rows with product and user columns; unmatched rows keep nulls.

    Anonymous rows can match no user. They get different negative keys, so that they do not all
    meet in one task of the join.
    """
    spread = F.lit(-2) - F.pmod(F.xxhash64("session_id", "partnumber", "timestamp_local"), F.lit(1 << 20))
    keyed = rows.withColumn(
        "_user", F.when(F.col("user_id") == ANONYMOUS, spread).otherwise(F.col("user_id"))
    ).drop("timestamp_local")
    people = users.withColumnRenamed("user_id", "_user")
    return (
        keyed.join(products.drop("embedding"), "partnumber", "left")
        .join(people, "_user", "left")
        .drop("_user")
    )
