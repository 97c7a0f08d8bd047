"""Candidate products per session, and how candidate rows get their context."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartloom.functions.numbers import steady_mean
from cartloom.operators.interactions import ANONYMOUS
from cartloom.operators.ordered import windowed
from cartloom.operators.sessions import SESSION_CONTEXT, mask_unknown_users


def global_candidates(train: DataFrame, n: int | None, metric: str = "interactions") -> DataFrame:
    """The n products with most interactions (or most `adds`); none for a falsy n."""
    counted = {"interactions": F.count("add_to_cart"), "adds": F.sum(F.col("add_to_cart").cast("bigint"))}
    counts = train.groupBy("partnumber").agg(counted[metric].alias("score"))
    return counts.orderBy(F.col("score").desc(), "partnumber").limit(n or 0)


def country_candidates(train: DataFrame, n: int) -> DataFrame:
    """Per country the n products with most cart additions."""
    sums = train.groupBy("country", "partnumber").agg(
        F.sum(F.col("add_to_cart").cast("bigint")).alias("total_add_to_cart")
    )
    best = Window.partitionBy("country").orderBy(F.col("total_add_to_cart").desc(), "partnumber")
    return sums.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def known_user_candidates(train: DataFrame, n: int) -> DataFrame:
    """Per known user the first n rows not added to the cart, most touched and longest first.

    A product can appear in several of the n rows.
    """
    seen = train.filter((F.col("user_id") != ANONYMOUS) & (F.col("add_to_cart") == 0))
    best = Window.partitionBy("user_id").orderBy(
        F.col("product_interaction_count").desc(), F.col("interaction_length").desc(), "interaction_id"
    )
    return (
        seen.select(
            "user_id", "partnumber", "product_interaction_count", "interaction_length", "interaction_id"
        )
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= n)
    )


def similar_candidates(test: DataFrame, similar: DataFrame) -> DataFrame:
    """(session, neighbour) for every product a session has seen."""
    seen = test.select("session_id", "partnumber").distinct()
    return seen.join(similar.select("partnumber", "neighbour"), "partnumber").select(
        "session_id", F.col("neighbour").alias("partnumber")
    )


# Where a candidate comes from.
SOURCES = ("global", "country", "user", "similar")


def candidate_rows(
    test: DataFrame,
    *,
    top_global: DataFrame | None = None,
    by_country: DataFrame | None = None,
    by_user: DataFrame | None = None,
    similar: DataFrame | None = None,
) -> DataFrame:
    """(session_id, partnumber, country, user_id, source) from all four sources, not yet distinct."""
    parts = []
    if top_global is not None:
        # The list is the n rows of a top-n: it rides along as one array.
        items = top_global.agg(F.collect_list("partnumber").alias("_items")).scalar()
        sessions = test.select("session_id").distinct()
        parts.append(
            sessions.withColumn("_items", items)
            .select("session_id", F.explode("_items").alias("partnumber"))
            .withColumn("source", F.lit("global"))
        )
    if by_country is not None:
        # One array per country, a smallint: at most 65,536 rows, so the sessions stay where they are.
        lists = by_country.groupBy("country").agg(F.collect_list("partnumber").alias("_items"))
        homes = test.select("session_id", "country").distinct()
        parts.append(
            homes.join(F.broadcast(lists), "country")
            .select("session_id", "country", F.explode("_items").alias("partnumber"))
            .withColumn("source", F.lit("country"))
        )
    if by_user is not None:
        people = test.filter(F.col("user_id") != ANONYMOUS).select("session_id", "user_id").distinct()
        parts.append(
            people.join(by_user.select("user_id", "partnumber"), "user_id")
            .withColumn("source", F.lit("user"))
        )
    if similar is not None:
        parts.append(similar_candidates(test, similar).withColumn("source", F.lit("similar")))
    if not parts:
        raise ValueError("no candidate source given")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    for column, kind in (("country", test.schema["country"].dataType), ("user_id", test.schema["user_id"].dataType)):
        if column not in out.columns:
            out = out.withColumn(column, F.lit(None).cast(kind))
    return out.withColumn("partnumber", F.col("partnumber").cast(test.schema["partnumber"].dataType))


def extend_test(test: DataFrame, *, dedupe: str = "row", **sources: DataFrame | None) -> DataFrame:
    """Test rows plus `synthetic_candidate = 1` rows from the given sources.

    dedupe "row": a candidate row counts once per different (session, product, country, user), so
    sources that know different context leave a product several times.
    dedupe "item": one row per (session, product) with the sorted list of its sources.
    """
    rows = candidate_rows(test, **sources)
    if dedupe == "row":
        made = rows.drop("source").distinct()
    elif dedupe == "item":
        made = rows.groupBy("session_id", "partnumber").agg(
            F.max("country").alias("country"), F.max("user_id").alias("user_id"),
            # Not more than the four names.
            F.array_sort(F.collect_set("source")).alias("sources"),
        )
    else:
        raise ValueError("dedupe must be 'row' or 'item'")
    made = made.withColumn("synthetic_candidate", F.lit(1).cast("bigint"))
    return test.unionByName(made, allowMissingColumns=True)


# Taken from the session's latest real row.
BACK_FILLED = (
    "timestamp_local", "user_id", "country", "device_type", "pagetype",
    "total_session_time", "day_number", "weekday_number", "hour", "day_frame",
)
# Taken as the mean over the session.
MEAN_FILLED = ("seconds_since_last_interaction", "interaction_length")


def fill_candidates(extended: DataFrame) -> DataFrame:
    """Candidate rows take the session's context: ten columns of its latest rows, two means, and
    the largest value of the seven columns that depend on the session.

    The context is one row per session, summed up in each task before the shuffle; a null takes
    the latest value that is not null.
    """
    real = extended.filter(F.col("synthetic_candidate").isNull())
    back = [c for c in BACK_FILLED if c in extended.columns]
    mean = [c for c in MEAN_FILLED if c in extended.columns]
    tops = [c for c in SESSION_CONTEXT if c in extended.columns]
    place = F.struct("timestamp_local", "interaction_id")
    context = real.groupBy("session_id").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_ctx_{c}") for c in back],
        *[steady_mean(F.col(c)).alias(f"_ctx_{c}") for c in mean],
        *[F.max(c).alias(f"_ctx_{c}") for c in tops],
    )
    made = extended.filter(F.col("synthetic_candidate") == 1).join(context, "session_id", "left")
    filled = made.withColumns({c: F.coalesce(F.col(c), F.col(f"_ctx_{c}")) for c in (*back, *mean, *tops)})
    return real.unionByName(filled.select(*extended.columns))


def candidate_touch_index(filled: DataFrame, *, order: str = "latest_first") -> DataFrame:
    """`product_interaction_count` on a test frame with candidates.

    order "latest_first": candidates count first, then real rows from the latest to the earliest.
    order "by_time": real rows by time as in train, candidates after them.
    """
    synthetic = F.col("synthetic_candidate").isNotNull()
    ties = [F.col("country").asc_nulls_first(), F.col("user_id").asc_nulls_first()]
    if order == "latest_first":
        by = [synthetic.desc(), F.col("timestamp_local").desc(), F.col("interaction_id").desc(), *ties]
    elif order == "by_time":
        by = [synthetic.asc(), F.col("timestamp_local").asc(), F.col("interaction_id").asc(), *ties]
    else:
        raise ValueError("order must be 'latest_first' or 'by_time'")
    return windowed(filled, ["session_id", "partnumber"], by, running={"product_interaction_count": F.lit(1)})


def finish_test(filled: DataFrame, *, order: str = "latest_first") -> DataFrame:
    """Filled test rows with touch index and -1 masks."""
    return mask_unknown_users(candidate_touch_index(filled, order=order))
