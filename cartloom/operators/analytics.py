"""The seven analytic questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartloom.operators.ordered import windowed


def lowest_family_product(products: DataFrame, color: int = 3, *, strict_global_min: bool = False) -> DataFrame:
    """Q1: the discounted product of a colour in the lowest family.

    `strict_global_min` takes the lowest family of all products instead of the lowest one that
    has such a product.
    """
    found = products.filter((F.col("color_id") == color) & (F.col("discount") == 1))
    if strict_global_min:
        lowest = products.agg(F.min("family").alias("family")).scalar()
        return found.filter(F.col("family") == lowest).select("partnumber").orderBy("partnumber").limit(1)
    return found.orderBy("family", "partnumber").limit(1).select("partnumber")


def lowest_family_product_sql(products: DataFrame, color: int = 3) -> DataFrame:
    """Q1 with the global minimum, as SQL text over a frame."""
    return products.sparkSession.sql(
        """
        SELECT min(partnumber) AS partnumber FROM {products}
        WHERE color_id = :color AND discount = 1 AND family = (SELECT min(family) FROM {products})
        HAVING count(*) > 0
        """,
        args={"color": color},
        products=products,
    )


def least_frequent_user(users: DataFrame, m_below: float = 500, *, distinct_users: bool = False) -> DataFrame:
    """Q2: in the country with most entries below `m_below`: lowest F, highest R, lowest id."""
    low = users.filter(F.col("M") < m_below)
    size = F.count_distinct("user_id") if distinct_users else F.count(F.lit(1))
    sizes = low.groupBy("country").agg(size.alias("_n"))
    country = sizes.agg(F.max_by("country", F.struct("_n", -F.col("country"))).alias("country")).scalar()
    return (
        users.filter(F.col("country") == country)
        .orderBy("F", F.col("R").desc(), "user_id")
        .limit(1)
        .select("user_id")
    )


def before_first_add(interactions: DataFrame) -> DataFrame:
    """(session_id, partnumber, before, group_adds) for every row of a product added at least once.

    `before` says that the row lies before the first add of its (session, product), `group_adds`
    how many adds that group has.
    """
    rows = interactions.select("session_id", "partnumber", "add_to_cart", "timestamp_local", "interaction_id")
    added = rows.filter(F.col("add_to_cart") == 1).select("partnumber").distinct()
    label = F.coalesce(F.col("add_to_cart").cast("bigint"), F.lit(0).cast("bigint"))
    marked = windowed(
        rows.withColumn("_label", label).join(added, "partnumber", "left_semi"), ["session_id", "partnumber"],
        [F.col("timestamp_local"), F.col("interaction_id")],
        running={"_adds": F.col("_label")}, overall={"group_adds": ("sum", "_label")},
    )
    return marked.select("session_id", "partnumber", (F.col("_adds") == 0).alias("before"), "group_adds")


def avg_visits_before_add(interactions: DataFrame, *, grain: str = "product") -> DataFrame:
    """Q3: mean number of visits before the first add, two decimals.

    grain "product": visits summed per product over all sessions, products without any left out.
    grain "session_product": over the (session, product) groups that have an add.
    """
    rows = before_first_add(interactions)
    if grain == "product":
        per = rows.filter("before").groupBy("partnumber").agg(F.count(F.lit(1)).alias("visits"))
    elif grain == "session_product":
        per = rows.filter("group_adds > 0").groupBy("session_id", "partnumber").agg(
            F.count_if("before").alias("visits")
        )
    else:
        raise ValueError("grain must be 'product' or 'session_product'")
    mean = F.sum("visits").cast("decimal(20,0)") / F.count("visits").cast("decimal(18,0)")
    return per.agg(F.round(mean, 2).cast("double").alias("average_previous_visits"))


def device_counts(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """Cart additions of discounted products per device."""
    sale = products.filter(F.col("discount") == 1).select("partnumber")
    added = interactions.filter(F.col("add_to_cart") == 1).select("partnumber", "device_type", "session_id")
    return added.join(sale, "partnumber").groupBy("device_type").agg(F.count("session_id").alias("count"))


def top_device_discounted_adds(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """Q4: the most used device for discounted cart additions."""
    return (
        device_counts(interactions, products)
        .orderBy(F.col("count").desc(), "device_type").limit(1).select("device_type")
    )


def top_frequency_users(users: DataFrame, k: int = 3) -> DataFrame:
    """Entries whose F is among the k highest of the country, each entry with a rank of its own."""
    best = Window.partitionBy("country").orderBy(F.col("F").desc(), "user_id", F.col("R").desc(), F.col("M").desc())
    return users.withColumn("rank_in_country", F.row_number().over(best)).filter(F.col("rank_in_country") <= k)


def top_user_by_distinct_products(
    interactions: DataFrame, users: DataFrame, k: int = 3, device: int = 3
) -> DataFrame:
    """Q5: of these users, the one with most different products on one device type."""
    top = top_frequency_users(users, k).select("user_id").distinct()
    rows = interactions.filter(F.col("device_type") == device).select("user_id", "partnumber")
    return (
        rows.join(top, "user_id", "left_semi")
        .groupBy("user_id")
        .agg(F.count_distinct("partnumber").alias("unique_products"))
        .orderBy(F.col("unique_products").desc(), "user_id")
        .limit(1)
        .select("user_id")
    )


def families_outside_home(interactions: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Q6: number of families seen in interactions outside the user's country (any of the entries).

    A user's entries are first merged to the pair lowest/highest country: some entry differs from
    a country exactly if one of these two does.
    """
    homes = users.groupBy("user_id").agg(F.min("country").alias("_low"), F.max("country").alias("_high"))
    away = (
        interactions.select("user_id", "country", "partnumber")
        .filter(F.col("user_id").isNotNull())
        .distinct()
        .join(homes, "user_id")
        .filter((F.col("country") != F.col("_low")) | (F.col("country") != F.col("_high")))
        .select("partnumber").distinct()
    )
    return away.join(products.select("partnumber", "family"), "partnumber").agg(
        (F.count_distinct("family") + F.coalesce(F.max(F.col("family").isNull().cast("int")), F.lit(0)))
        .alias("unique_families")
    )


def top_pagetype_per_family(
    interactions: DataFrame, products: DataFrame, first: str, last: str
) -> DataFrame:
    """Q7: most frequent page type of the cart additions of each family; the smallest on a tie.

    Both bounds are timestamps and inclusive: `last = "2024-06-07"` ends at that day's midnight.
    """
    added = interactions.filter(
        F.col("timestamp_local").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))
        & (F.col("add_to_cart") == 1)
    )
    counts = (
        added.select("partnumber", "pagetype", "session_id")
        .join(products.select("partnumber", "family"), "partnumber", "left")
        .groupBy("family", "pagetype")
        .agg(F.count("session_id").alias("_n"))
    )
    best = Window.partitionBy("family").orderBy(F.col("_n").desc(), F.col("pagetype").asc_nulls_first())
    return (
        counts.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") == 1)
        .select("family", "pagetype")
    )
