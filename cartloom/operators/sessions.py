"""Per-session metrics and per-row session features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.functions.calendar import day_frame, iso_weekday
from cartloom.functions.numbers import rounded, seconds_between
from cartloom.operators.ordered import windowed


def with_timestamps(df: DataFrame) -> DataFrame:
    """Text timestamps are parsed; others are left alone."""
    if dict(df.dtypes)["timestamp_local"] == "string":
        df = df.withColumn("timestamp_local", F.to_timestamp_ntz("timestamp_local"))
    return df


def session_aggregates(interactions: DataFrame) -> DataFrame:
    """First and last time, adds and rows per (user, session): combined in each task first."""
    return interactions.groupBy("user_id", "session_id").agg(*session_sums())


def session_sums() -> list[Column]:
    return [
        F.min("timestamp_local").alias("first_seen"),
        F.max("timestamp_local").alias("last_seen"),
        F.sum(F.col("add_to_cart").cast("bigint")).alias("adds"),
        F.count(F.lit(1)).alias("rows"),
    ]


def session_metric_columns() -> list[Column]:
    percent = F.bround(
        (F.coalesce(F.col("adds"), F.lit(0)) * 100).cast("decimal(20,0)") / F.col("rows").cast("decimal(18,0)"), 2
    )
    return [
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("session_id").cast("bigint").alias("session_id"),
        rounded(seconds_between(F.col("first_seen"), F.col("last_seen")), 2).alias("total_session_time"),
        percent.cast("double").alias("cart_addition_ratio"),
    ]


def session_metrics(interactions: DataFrame, user_id: int | None = None) -> DataFrame:
    """Duration in seconds and percentage of cart additions of each session, by user and session.

    `user_id` keeps one user (an unknown one gives an empty frame of the same columns); without
    it all known users are done in one job. Sorted only for one user.
    """
    rows = with_timestamps(interactions)
    rows = rows.filter(F.col("user_id").isNotNull() if user_id is None else F.col("user_id") == user_id)
    metrics = session_aggregates(rows).select(*session_metric_columns())
    return metrics if user_id is None else metrics.orderBy("session_id")


def session_row_features(df: DataFrame) -> DataFrame:
    """Times and size of the session for every row, from one pass over one sort."""
    ts, by = "timestamp_local", ["timestamp_local", "interaction_id"]
    wide = windowed(
        df, ["session_id"], [F.col(c) for c in by], position=by,
        previous={"_before": ts}, following={"_after": ts},
        overall={
            "_first": ("min", ts), "_last": ("max", ts),
            "total_session_interactions": ("count", ts),
        },
    )
    zero = F.lit(0.0)
    return wide.withColumns({
        "seconds_since_last_interaction": F.coalesce(rounded(seconds_between(F.col("_before"), F.col(ts)), 1), zero),
        "total_session_time": F.coalesce(rounded(seconds_between(F.col("_first"), F.col("_last")), 1), zero),
        "interaction_length": F.coalesce(rounded(seconds_between(F.col(ts), F.col("_after")), 1), zero),
    }).drop("_before", "_after", "_first", "_last")


def session_time_features(df: DataFrame) -> DataFrame:
    """Seconds since the row before, length of the session, seconds to the row after."""
    return session_row_features(df).drop("total_session_interactions")


def session_size(df: DataFrame) -> DataFrame:
    """Number of interactions of the row's session."""
    sizes = df.groupBy("session_id").agg(F.count("timestamp_local").alias("total_session_interactions"))
    return df.join(sizes, "session_id", "left")


def calendar_features(df: DataFrame) -> DataFrame:
    ts = F.col("timestamp_local")
    return df.withColumns({
        "day_number": F.dayofmonth(ts),
        "weekday_number": iso_weekday(ts),
        "hour": F.hour(ts),
        "day_frame": day_frame(F.hour(ts)).cast("tinyint"),
    })


def product_touch_index(df: DataFrame) -> DataFrame:
    """`product_interaction_count`: the row is the nth of its (session, product), by time."""
    return windowed(
        df, ["session_id", "partnumber"], [F.col("timestamp_local"), F.col("interaction_id")],
        running={"product_interaction_count": F.lit(1)},
    )


def fill_session_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null <- largest value of the column in the session."""
    tops = df.groupBy("session_id").agg(*[F.max(c).alias(f"_max_{c}") for c in columns])
    filled = df.join(tops, "session_id", "left").withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_max_{c}")) for c in columns}
    )
    return filled.drop(*[f"_max_{c}" for c in columns])


def fill_session_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null <- mean of the column in the session."""
    means = df.groupBy("session_id").agg(*[F.avg(c).alias(f"_avg_{c}") for c in columns])
    filled = df.join(means, "session_id", "left").withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col(f"_avg_{c}")) for c in columns}
    )
    return filled.drop(*[f"_avg_{c}" for c in columns])


# Columns a row without context takes from its session's other rows.
SESSION_CONTEXT = (
    "known_user", "page_cart_ratio", "device_cart_ratio", "country_cart_ratio",
    "user_previous_cart_additions", "user_previous_interactions", "total_session_interactions",
)


def mask_unknown_users(df: DataFrame) -> DataFrame:
    """-1 for the running user counts of anonymous rows."""
    unknown = F.col("known_user") == -1
    return df.withColumns({
        c: F.when(unknown, F.lit(-1)).otherwise(F.col(c)).cast("bigint")
        for c in ("user_previous_cart_additions", "user_previous_interactions")
    })


def fill_session_nulls(df: DataFrame) -> DataFrame:
    return mask_unknown_users(fill_session_max(df, SESSION_CONTEXT))
