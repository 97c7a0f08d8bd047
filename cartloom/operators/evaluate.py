"""Quality of scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _discounts(first: Column, last: Column) -> Column:
    """Sum of 1 / log2(position + 1) over the positions first..last; 0 for an empty range."""
    positions = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(positions, F.lit(0.0), lambda acc, i: acc + F.lit(1.0) / F.log2(i.cast("double") + 1.0))


def session_ndcg(
    scored: DataFrame, k: int = 5, *, score: str = "score", label: str = "add_to_cart", no_positive: float | None = 0.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """(session_id, ndcg) with binary relevance and log2 discount; with `by`, for each value of these columns, which lead.

    Equal scores share the mean gain of the places they fill. Sessions without a positive get
    `no_positive`; None leaves them out. Rows are first merged per (session, score), of which at
    most the k best can reach the first k places.
    """
    keys = [*by, "session_id"]
    scored = scored.select(*keys, F.col(score).alias("_score"), F.col(label).cast("bigint").alias("_rel"))
    groups = scored.groupBy(*keys, "_score").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("_rel").alias("_gain")
    )
    best = Window.partitionBy(*keys).orderBy(F.col("_score").desc())
    top = groups.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= k)
    done = F.sum("_rows").over(best.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    reach = top.withColumn("_done", done).withColumn(
        "_dcg",
        F.col("_gain") / F.col("_rows")
        * _discounts(F.col("_done") - F.col("_rows") + 1, F.least(F.col("_done"), F.lit(k).cast("bigint"))),
    )
    dcg = reach.groupBy(*keys).agg(F.sum("_dcg").alias("_dcg"))
    positives = scored.groupBy(*keys).agg(F.sum("_rel").alias("_pos"))
    ideal = _discounts(F.lit(1).cast("bigint"), F.least(F.col("_pos"), F.lit(k).cast("bigint")))
    out = positives.join(dcg, keys).select(
        *keys,
        F.when(F.col("_pos") > 0, F.try_divide(F.col("_dcg"), ideal)).otherwise(F.lit(no_positive)).alias("ndcg"),
    )
    return out.filter(F.col("ndcg").isNotNull()) if no_positive is None else out


def ndcg_at_k(scored: DataFrame, k: int = 5, *, by: Sequence[str] = (), **options) -> DataFrame:
    """Mean over the sessions, one row; with `by`, one for each value of these columns."""
    sessions = session_ndcg(scored, k, by=by, **options)
    return sessions.groupBy(*by).agg(F.avg("ndcg").alias("ndcg"), F.count(F.lit(1)).alias("sessions"))


def pooled_f1(scored: DataFrame, *, prediction: str = "prediction", label: str = "add_to_cart") -> DataFrame:
    """True and false positives, false negatives, and F1 of a 0/1 prediction, one row."""
    hit, real = F.col(prediction) == 1, F.col(label) == 1
    counts = scored.agg(
        F.count_if(hit & real).alias("tp"), F.count_if(hit & ~real).alias("fp"), F.count_if(~hit & real).alias("fn")
    )
    f1 = F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return counts.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def recommend(scored: DataFrame, k: int = 5, *, score: str = "score", distinct_items: bool = True) -> DataFrame:
    """(session_id, rank, partnumber, score): the k best per session, ties to the smaller product.

    `distinct_items` counts a product once, with its best score.
    """
    rows = scored.select("session_id", "partnumber", F.col(score).alias("score"))
    if distinct_items:
        rows = rows.groupBy("session_id", "partnumber").agg(F.max("score").alias("score"))
    best = Window.partitionBy("session_id").orderBy(F.col("score").desc(), "partnumber")
    return (
        rows.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("session_id", "rank", "partnumber", "score")
    )


def recommendation_lists(top: DataFrame) -> DataFrame:
    """(session_id, items): one array per session, best first."""
    lists = top.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("rank", "partnumber"))).alias("_l"))
    return lists.select("session_id", F.col("_l.partnumber").alias("items"))
