"""Sketches against exact sets, and the row cap against a sorted list."""

import pytest
from pyspark.sql import functions as F

from cartloom.operators import sketches as SK
from cartloom.operators.sampling import first_rows


@pytest.fixture(scope="module")
def rows(spark):
    # 60,000 ids, a third of all rows on one of them; ten days; a column with nulls.
    ids = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(90_000).select(ids.alias("key"), (F.col("id") % 10).alias("day"), F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("few")).cache()


def test_merged_days_count_like_the_whole(rows):
    by_day = SK.column_sketches(rows, ["key", "few"], ["day"])
    assert by_day.count() == 20
    got = {r.column_name: r.estimate for r in SK.distinct_estimates(SK.merged(by_day)).collect()}
    # Even rests below 50, and null.
    assert got["few"] == 26
    assert abs(got["key"] - 60_001) <= SK.relative_bound() * 60_001
    merged_again = SK.merged(SK.merged(by_day).unionByName(by_day.drop("day")))
    assert {r.column_name: r.estimate for r in SK.distinct_estimates(merged_again).collect()} == got


def test_overlaps(rows):
    left, right = rows.filter("key < 60000"), rows.filter("key >= 30000 or key = 0")
    a, b = ({r["key"] for r in d.select("key").distinct().collect()} for d in (left, right))
    got = SK.overlap_estimates(SK.column_sketches(left, ["key"]), SK.column_sketches(right, ["key"])).first()
    bound = SK.relative_bound() * len(a | b)
    for value, truth in ((got.common, a & b), (got.train_only, a - b), (got.test_only, b - a), (got.either, a | b)):
        assert abs(value - len(truth)) <= bound


def test_empty_and_few(spark, rows):
    none = SK.column_sketches(rows.filter("key < 0"), ["key"])
    assert [r.estimate for r in SK.distinct_estimates(SK.merged(none)).collect()] == [0]
    some = SK.column_sketches(rows.filter("key between 1 and 30"), ["key"])
    got = SK.overlap_estimates(some, none).first()
    assert (got.common, got.train_only, got.test_only, got.either) == (0, 20, 0, 20)


@pytest.mark.parametrize("n", [0, 1, 999, 30_001, 90_000, 200_000])
def test_first_rows_in_order(rows, n):
    got = sorted((r["key"], r["day"], r["few"]) if r["few"] is not None else (r["key"], r["day"], -1) for r in first_rows(rows, n, ["key", "day", "few"]).collect())
    every = sorted((r["key"], r["day"], r["few"]) if r["few"] is not None else (r["key"], r["day"], -1) for r in rows.collect())
    assert got == every[:n]
