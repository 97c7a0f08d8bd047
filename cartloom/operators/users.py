"""User features: one row per user, ratios, country comparison, flags and RFM segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.functions.numbers import finite_or_zero, ratio, steady_mean
from cartloom.operators.ordered import same_keys
from cartloom.operators.quantiles import cumulative_counts, exact_quantiles
from cartloom.session import stage

QUINTILES = (0.2, 0.4, 0.6, 0.8)


def dedupe_users(users: DataFrame, *, latest: str = "highest") -> DataFrame:
    """One entry per user: highest F, then highest (or `latest="lowest"`) R; country renamed.

    A struct maximum, so each task sends at most one row per user.
    """
    recency = F.col("R") if latest == "highest" else -F.col("R")
    best = F.max_by(
        F.struct("country", "R", "F", "M"), F.struct("F", recency, "M", -F.col("country"))
    )
    return (
        users.groupBy("user_id")
        .agg(best.alias("_best"))
        .select(
            "user_id",
            F.col("_best.country").alias("user_country"),
            F.col("_best.R").alias("R"),
            F.col("_best.F").alias("F"),
            F.col("_best.M").alias("M"),
        )
    )


def user_ratio_features(users: DataFrame) -> DataFrame:
    """Five ratios of R, F, M. A zero divisor gives 0 in three of them and null in the first."""
    r, f, m = F.col("R"), F.col("F"), F.col("M")
    return users.withColumns({
        "avg_value_per_purchase": ratio(m, f),
        "purchase_rate": finite_or_zero(ratio(f, r)),
        "spend_rate_per_day": finite_or_zero(ratio(m, r)),
        "total_value_frequency": m * f,
        "avg_days_between_purchases": finite_or_zero(ratio(r, f)),
    })


def country_means(users: DataFrame) -> DataFrame:
    """Mean M, F, R per country. `user_country` is a smallint: at most 65,536 rows."""
    return users.groupBy(F.col("user_country").cast("smallint").alias("user_country")).agg(
        steady_mean(F.col("M")).alias("country_avg_monetary"),
        F.avg("F").alias("country_avg_frequency"),
        F.avg("R").alias("country_avg_recency"),
    )


def user_country_features(users: DataFrame) -> DataFrame:
    """Country means and each user's value relative to them."""
    joined = users.join(F.broadcast(country_means(users)), "user_country")
    return joined.withColumns({
        "relative_monetary_value": ratio(F.col("M"), F.col("country_avg_monetary")),
        "relative_frequency": ratio(F.col("F"), F.col("country_avg_frequency")),
        "relative_recency": ratio(F.col("R"), F.col("country_avg_recency")),
    })


def user_flags(users: DataFrame) -> DataFrame:
    """Six 0/1 flags: M, F, R above the country's and above the overall mean."""
    own = "country_avg_monetary" in users.columns
    based = users if own else user_country_features(users)
    means = users.agg(F.struct(steady_mean(F.col("M")).alias("M"), F.avg("F").alias("F"), F.avg("R").alias("R")))
    overall = means.scalar()
    flagged = based.withColumn("_all", overall).withColumns({
        "is_high_value_incountry": (F.col("M") > F.col("country_avg_monetary")).cast("tinyint"),
        "is_frequent_buyer_incountry": (F.col("F") > F.col("country_avg_frequency")).cast("tinyint"),
        "is_recent_customer_incountry": (F.col("R") > F.col("country_avg_recency")).cast("tinyint"),
        "is_high_value": (F.col("M") > F.col("_all.M")).cast("tinyint"),
        "is_frequent_buyer": (F.col("F") > F.col("_all.F")).cast("tinyint"),
        "is_recent_customer": (F.col("R") > F.col("_all.R")).cast("tinyint"),
    })
    return flagged.drop("_all")


def rank_table(users: DataFrame, values: Sequence[str] = ("R", "F", "M")) -> DataFrame:
    """(metric, user_country, value, n, rank) for all metrics from one pass: the mean-method rank."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("value")) for v in values
    ]))
    long = users.select("user_country", pairs.alias("_p")).select("user_country", "_p.*")
    steps = cumulative_counts(long, ["metric", "user_country"], "value", falling=True)
    rank = F.col("upto") - (F.col("n") - 1) / F.lit(2.0)
    return steps.select("metric", "user_country", "value", "n", rank.alias("rank"))


def _with_rank_columns(users: DataFrame, ranks: DataFrame, values: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """Join `columns` of the rank table to the users, once per metric (names get its letter)."""
    out = users
    for value in values:
        own = ranks.filter(F.col("metric") == value).select(
            "user_country", F.col("value").alias("_value"),
            *[c.alias(f"{value.lower()}_{name}") for name, c in columns.items()],
        )
        out = out.withColumn("_value", F.col(value).cast("double"))
        out = same_keys(out, own, ["user_country", "_value"], "left").drop("_value")
    return out


def rfm_ranks(users: DataFrame, values: Sequence[str] = ("R", "F", "M")) -> DataFrame:
    """`r/f/m_rank_in_country`: the mean-method rank in the country, cut to int."""
    ranks = stage(rank_table(users, values), "ranks")
    return _with_rank_columns(users, ranks, values, {"rank_in_country": F.col("rank").cast("int")})


def rfm_segments(
    users: DataFrame, *, scope: str = "pooled", values: Sequence[str] = ("R", "F", "M")
) -> DataFrame:
    """`r/f/m_segment` 1..5 (1 = best) by quintile of the country rank, plus the ranks.

    scope "pooled" cuts the ranks of all countries together, "country" each country by itself.
    Equal edges merge. Edges and segments are found on the rank table, which is written once;
    the users are joined to it once per metric.
    """
    if scope not in ("pooled", "country"):
        raise ValueError("scope must be 'pooled' or 'country'")
    ranks = stage(rank_table(users, values), "ranks")
    # Three metrics, or three per smallint country: at most 3 * 65,536 rows.
    keys = ["metric"] if scope == "pooled" else ["metric", "user_country"]
    ranks = ranks.withColumn("user_country", F.col("user_country").cast("smallint"))
    edges = exact_quantiles(ranks, keys, "rank", QUINTILES, weight="n").drop("n")
    segment = F.lit(1) + F.size(F.filter(F.array_distinct("edges"), lambda e: F.col("rank") > e))
    return _with_rank_columns(
        users, same_keys(ranks, F.broadcast(edges), keys), values,
        {"segment": segment.cast("tinyint"), "rank_in_country": F.col("rank").cast("int")},
    )


def user_features(users: DataFrame) -> DataFrame:
    """All user columns of the model for one row per user (see `dedupe_users`)."""
    return rfm_segments(user_flags(user_country_features(user_ratio_features(users))))
