"""Ranking quality, recommendations and the choice of rows."""

from math import log2

import pytest
from pyspark.sql import functions as F

from cartloom.operators import evaluate as E
from cartloom.operators import folds as FO


def brute_ndcg(rows, k):
    """Mean over all orders of tied rows, by giving each tied row its group's mean gain."""
    scores = sorted({s for s, _ in rows}, reverse=True)
    gains = []
    for s in scores:
        group = [g for x, g in rows if x == s]
        gains += [sum(group) / len(group)] * len(group)
    dcg = sum(g / log2(i + 2) for i, g in enumerate(gains[:k]))
    ideal = sum(g / log2(i + 2) for i, g in enumerate(sorted((g for _, g in rows), reverse=True)[:k]))
    return dcg / ideal if ideal else 0.0


DATA = {
    1: [(0.9, 0), (0.8, 1), (0.7, 1), (0.1, 0)],
    2: [(0.5, 1)] * 2 + [(0.5, 0)] * 6 + [(0.2, 1)],
    3: [(0.3, 0), (0.2, 0)],
    4: [(float(i), int(i == 0)) for i in range(10)],
    5: [(1.0, 1)],
}


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(s, i, x, g) for s, group in DATA.items() for i, (x, g) in enumerate(group)]
    return spark.createDataFrame(rows, "session_id long, partnumber int, score double, add_to_cart int")


@pytest.mark.parametrize("k", [1, 3, 5, 20])
def test_ndcg(scored, k):
    got = {r.session_id: r.ndcg for r in E.session_ndcg(scored, k).collect()}
    assert got == pytest.approx({s: brute_ndcg(rows, k) for s, rows in DATA.items()})
    assert all(0 <= v <= 1 + 1e-12 for v in got.values())


def test_sessions_without_positive(scored):
    assert E.session_ndcg(scored, no_positive=None).filter("session_id = 3").count() == 0
    assert E.session_ndcg(scored, no_positive=1.0).filter("session_id = 3").first().ndcg == 1.0
    assert E.ndcg_at_k(scored).first().sessions == 5


def test_f1(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] * 2 + [(0, 1)] + [(0, 0)] * 4, "prediction int, add_to_cart int")
    row = E.pooled_f1(df).first()
    assert (row.tp, row.fp, row.fn) == (3, 2, 1) and row.f1 == pytest.approx(2 * 3 / (2 * 3 + 2 + 1))
    assert E.pooled_f1(df.filter("prediction = 0 AND add_to_cart = 0")).first().f1 == 0.0


def test_recommend(spark):
    df = spark.createDataFrame([(1, p, s) for p, s in ((7, .9), (7, .8), (3, .9), (4, .1), (5, .2), (6, .3), (8, .05))], "session_id long, partnumber int, score double")
    lists = E.recommendation_lists(E.recommend(df))
    assert [list(r["items"]) for r in lists.collect()] == [[3, 7, 6, 5, 4]]
    repeated = E.recommendation_lists(E.recommend(df, distinct_items=False))
    assert [list(r["items"]) for r in repeated.collect()] == [[3, 7, 7, 6, 5]]


@pytest.fixture(scope="module")
def train(spark):
    rows = [(i, i % 90, int(i % 7 == 0)) for i in range(1800)]
    return spark.createDataFrame(rows, "interaction_id long, session_id long, add_to_cart int")


def test_downsample(train):
    pos = train.filter("add_to_cart = 1").count()
    got = FO.downsample_negatives(train, 2.5)
    assert got.filter("add_to_cart = 1").count() == pos
    assert got.filter("add_to_cart = 0").count() == int(pos * 2.5)
    assert FO.downsample_negatives(train, None) is train and FO.downsample_negatives(train, 0) is train
    assert FO.downsample_negatives(train, 2.0, is_train=False) is train
    assert FO.downsample_negatives(train, 100.0).count() == 1800


def test_holdout_never_splits_a_session(train):
    rest, held = FO.session_holdout(train, 0.1)
    a, b = ({r.session_id for r in x.select("session_id").distinct().collect()} for x in (rest, held))
    assert len(b) == 9 and not a & b and len(a | b) == 90
    assert rest.count() + held.count() == 1800


def test_folds(train):
    folds = FO.group_folds(train).select("session_id", "fold").distinct().groupBy("session_id").count()
    assert folds.filter("count > 1").count() == 0
    strat = FO.stratified_session_folds(train).groupBy("adds", "fold").count().toPandas()
    for _, part in strat.groupby("adds"):
        assert part["count"].max() - part["count"].min() <= 1 or len(part) < 5
    assert FO.stratified_group_folds(train).count() == 1800


def test_min_adds(spark):
    df = spark.createDataFrame([(1, 1)] * 5 + [(2, 1)] * 4 + [(2, 0)], "session_id long, add_to_cart int")
    assert {r.session_id for r in FO.sessions_with_min_adds(df, 5).collect()} == {1}
    assert {(r.session_id, r["rows"]) for r in FO.group_sizes(df).collect()} == {(1, 5), (2, 5)}


def test_fit_reads_rows_written_once(spark, monkeypatch):
    """The joins for hold-out and weights run once per fit, not in each pass of the fit."""
    from pyspark.ml import Pipeline

    from cartloom.operators import ranking as R
    from cartloom.operators.folds import session_holdout

    rows = spark.createDataFrame([(i // 4, float(i % 7), i % 3 == 0) for i in range(400)], "session_id long, R double, add_to_cart boolean")
    plans = []
    fit = Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or fit(self, df))
    model = R.fit_ranker(*session_holdout(rows.withColumn("add_to_cart", rows.add_to_cart.cast("int")), 0.2), features=("R",), rounds=2)
    assert len(plans) == 1 and "Join" not in plans[0]
    assert R.feature_names(model) == ["R"]
