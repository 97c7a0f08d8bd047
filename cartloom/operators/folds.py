"""Choosing rows and sessions for training: thresholds, downsampling, hold-out and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.functions.hashing import draw, draw_number
from cartloom.operators.ordered import windowed
from cartloom.operators.sampling import draw_rows


def sessions_with_min_adds(train: DataFrame, adds: int = 5) -> DataFrame:
    """All rows of the sessions with at least `adds` cart additions."""
    keep = train.groupBy("session_id").agg(F.sum(F.col("add_to_cart").cast("bigint")).alias("_adds"))
    return train.join(keep.filter(F.col("_adds") >= adds).select("session_id"), "session_id", "left_semi")


def downsample_negatives(
    df: DataFrame,
    ratio: float | None,
    *,
    seed: int = 23,
    key: Sequence[str] = ("interaction_id",),
    is_train: bool = True,
) -> DataFrame:
    """All positives and int(positives * ratio) random negatives; unchanged without a ratio."""
    if not is_train or not ratio:
        return df
    positives = df.filter(F.col("add_to_cart") == 1)
    negatives = df.filter(F.col("add_to_cart") == 0)
    wanted = positives.agg(F.floor(F.count(F.lit(1)) * F.lit(float(ratio))).alias("_wanted")).scalar()
    return draw_rows(negatives, key, wanted, seed).unionByName(positives)


def sample_sessions(df: DataFrame, share: float, seed: int = 23) -> DataFrame:
    """int(sessions * share) random session ids."""
    sessions = df.select("session_id").distinct()
    wanted = sessions.agg(F.floor(F.count(F.lit(1)) * F.lit(float(share))).alias("_wanted")).scalar()
    return draw_rows(sessions, ["session_id"], wanted, seed)


def session_holdout(df: DataFrame, share: float = 0.1, seed: int = 23) -> tuple[DataFrame, DataFrame]:
    """(train, validation): a random share of the sessions is held out whole."""
    held = sample_sessions(df, share, seed)
    return df.join(held, "session_id", "left_anti"), df.join(held, "session_id", "left_semi")


def group_folds(df: DataFrame, k: int = 5, seed: int = 23) -> DataFrame:
    """`fold` 0..k-1 by session; no shuffle, the session id alone decides."""
    fold = F.pmod(draw_number(draw("session_id", seed=seed)), F.lit(k)).cast("int")
    return df.withColumn("fold", fold)


def stratified_session_folds(df: DataFrame, k: int = 5, seed: int = 23) -> DataFrame:
    """(session_id, adds, fold): sessions with equally many adds are dealt out in random order.

    One stratum can hold most sessions, so the order inside a stratum is built by range.
    """
    sessions = df.groupBy("session_id").agg(F.sum(F.col("add_to_cart").cast("bigint")).alias("adds"))
    drawn = sessions.withColumn("_draw", draw("session_id", seed=seed))
    dealt = windowed(drawn, ["adds"], [F.col("_draw"), F.col("session_id")], running={"_nth": F.lit(1)})
    return dealt.select("session_id", "adds", F.pmod(F.col("_nth") - 1, F.lit(k)).cast("int").alias("fold"))


def stratified_group_folds(df: DataFrame, k: int = 5, seed: int = 23) -> DataFrame:
    """`df` with the fold of its session."""
    return df.join(stratified_session_folds(df, k, seed).select("session_id", "fold"), "session_id")


def group_sizes(df: DataFrame) -> DataFrame:
    """Rows per session."""
    return df.groupBy("session_id").agg(F.count(F.lit(1)).alias("rows"))
