"""User and product operators on hand-made frames."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartloom.operators import products as P
from cartloom.operators import users as U


@pytest.fixture(scope="module")
def users(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(i % 3), int(rng.integers(0, 40)), int(rng.integers(0, 6)), float(rng.integers(1, 900)) / 4) for i in range(200)]
    return spark.createDataFrame(rows, "user_id long, user_country smallint, R int, F int, M double").cache()


def test_dedupe_takes_highest_f_then_r(spark):
    df = spark.createDataFrame(
        [(1, 5, 3, 2, 1.0), (1, 6, 9, 2, 0.5), (1, 7, 99, 1, 9.0), (2, 5, 0, 0, 0.0)],
        "user_id long, country smallint, R int, F int, M double")
    got = {tuple(r) for r in U.dedupe_users(df).collect()}
    assert got == {(1, 6, 9, 2, 0.5), (2, 5, 0, 0, 0.0)}
    assert {r.R for r in U.dedupe_users(df, latest="lowest").collect()} == {3, 0}


def test_zero_divisors(spark):
    df = spark.createDataFrame([(1, 1, 0, 0, 5.0), (2, 1, 4, 2, 8.0)], "user_id long, user_country smallint, R int, F int, M double")
    a, b = U.user_ratio_features(df).orderBy("user_id").collect()
    assert (a.avg_value_per_purchase, a.purchase_rate, a.spend_rate_per_day, a.avg_days_between_purchases) == (None, 0.0, 0.0, 0.0)
    assert (b.avg_value_per_purchase, b.purchase_rate, b.total_value_frequency, b.avg_days_between_purchases) == (4.0, 0.5, 16.0, 2.0)


def test_ranks_and_segments_match_pandas(users):
    got = U.rfm_segments(users).toPandas().sort_values("user_id").reset_index(drop=True)
    base = users.toPandas().sort_values("user_id").reset_index(drop=True)
    for c in "RFM":
        rank = base.groupby("user_country")[c].rank(ascending=False, method="average")
        assert (got[f"{c.lower()}_rank_in_country"] == rank.astype(int)).all()
        cut = pd.qcut(rank, 5, labels=False, duplicates="drop") + 1
        assert (got[f"{c.lower()}_segment"] == cut).all()


def test_segments_by_country(users):
    got = U.rfm_segments(users, scope="country").toPandas().sort_values("user_id").reset_index(drop=True)
    base = users.toPandas().sort_values("user_id").reset_index(drop=True)
    rank = base.groupby("user_country").M.rank(ascending=False)
    cut = rank.groupby(base.user_country).transform(lambda x: pd.qcut(x, 5, labels=False, duplicates="drop") + 1)
    assert (got.m_segment == cut).all()
    assert got.m_segment.between(1, 5).all()


def test_flags_and_country_means(users):
    got = U.user_flags(users).toPandas()
    assert ((got.M > got.groupby("user_country").M.transform("mean")).astype(int) == got.is_high_value_incountry).all()
    assert ((got.R > got.R.mean()).astype(int) == got.is_recent_customer).all()


PRODUCTS = "partnumber int, family int, color_id int, cod_section smallint, discount int, embedding array<float>"


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([
        (1, 10, 1, 5, 1, [3.0, 4.0]), (2, 10, None, 4, 0, [1.0, 0.0]), (3, 10, 1, None, 0, None),
        (4, 11, 2, None, 1, None), (5, None, 2, 7, 1, [0.0, 0.0]), (6, None, 3, None, 0, None),
    ], PRODUCTS)


def test_embedding_imputation(products):
    got = {r.partnumber: r.embedding for r in P.impute_embeddings(products).collect()}
    assert got[3] == [2.0, 2.0]
    # family 10 holds 3 filled rows, product 5 its own vector
    assert got[4] == got[6] == [1.5, 1.5]
    assert got[1] == [3.0, 4.0]


def test_section_mode_takes_the_smallest_on_a_tie(products):
    got = {r.partnumber: r.cod_section for r in P.impute_section(products).collect()}
    assert got == {1: 5, 2: 4, 3: 4, 4: None, 5: 7, 6: None}


def test_unit_vectors(products):
    got = {r.partnumber: r.embedding for r in P.normalize_embedding(products).collect()}
    assert got[1] == pytest.approx([0.6, 0.8]) and got[5] == [0.0, 0.0] and got[6] is None


def test_statistics_treat_null_as_a_group(products):
    got = {r.partnumber: r for r in P.product_statistics(products).collect()}
    assert (got[1].color_family_frequency, got[1].family_unique_colors) == (2, 2)
    assert got[6].family_unique_colors == 2 and got[6].family_discount_rate == 0.5
    assert got[3].section_discount_rate == pytest.approx(1 / 3)


def test_universe(spark, products):
    seen = spark.createDataFrame([(1,), (1,), (9,)], "partnumber int")
    universe = P.product_universe(seen, spark.createDataFrame([(2,)], "partnumber int"))
    assert {r.partnumber for r in universe.collect()} == {1, 2, 9}
    assert {r.partnumber for r in P.restrict_products(products, universe).collect()} == {1, 2}
