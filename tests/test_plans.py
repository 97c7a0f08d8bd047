"""Plan shapes and the way from tables to recommendations."""


import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from cartloom.operators import candidates as C
from cartloom.operators.evaluate import ndcg_at_k
from cartloom.operators.ranking import FEATURES
from cartloom.plans import recommender as REC
from cartloom.session import shared_folder, stage
from cartloom.sources import fixtures

QUERIES = contract.queries()


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "session_metrics", "q3_avg_visits_before_add", "user_running_counts", "session_time_features", "cand_country",
    "rfm_segments", "session_ndcg", "downsample", "cosine_pairs", "q6_families_outside_home", "user_flags",
])
def test_no_cross_product(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["user_running_counts", "session_time_features", "user_flags", "group_folds", "cart_ratios"])
def test_rows_never_meet_in_one_partition(spark, small, name):
    lines = plan(QUERIES[name](spark, small)).splitlines()
    below = [b for a, b in zip(lines, lines[1:]) if "Exchange SinglePartition" in a]
    # One row per task, already summed up, may meet; rows may not.
    assert all("functions=[partial_" in line for line in below)


def test_user_filter_and_columns_reach_the_scan(spark, small):
    from cartloom.operators.sessions import session_metrics
    from cartloom.sources.readers import load_data

    path = stage(fixtures.interactions(spark, small), "interactions").inputFiles()
    text = plan(session_metrics(load_data(spark, path, file_type="parquet"), 7))
    assert "EqualTo(user_id,7)" in text
    schema = text.split("ReadSchema: ")[1]
    assert "partnumber" not in schema and "country" not in schema


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.fixture(scope="module")
def tables(spark, small):
    options = REC.Options(min_adds=1, holdout=0.3, ranker={"rounds": 4, "maxDepth": 3})
    built = REC.build_tables(
        fixtures.train(spark, small), fixtures.test(spark, small), fixtures.users(spark, small), fixtures.products(spark, small), options
    )
    return options, built


def test_feature_tables(spark, small, tables):
    _, built = tables
    assert built.train.count() == fixtures.train(spark, small).count()
    assert set(FEATURES) <= set(built.train.columns) and set(FEATURES) <= set(built.test.columns)
    real = built.test.filter(F.col("synthetic_candidate").isNull())
    assert real.count() == fixtures.test(spark, small).count()
    lost = built.test.filter(F.col("country").isNull() | F.col("hour").isNull() | F.col("known_user").isNull())
    assert lost.count() == 0


def test_recommendations(tables):
    options, built = tables
    model, scored = REC.train_ranker(built.train, options)
    quality = ndcg_at_k(scored).first()
    assert 0 <= quality.ndcg <= 1 and quality.sessions > 0
    lists = REC.recommendations(built.test, model).collect()
    assert len(lists) == built.test.select("session_id").distinct().count()
    assert all(len(r["items"]) == len(set(r["items"])) <= 5 for r in lists)


def test_partitions_change_no_feature(spark, small):
    train, test = fixtures.train(spark, small), fixtures.test(spark, small)

    def rows(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            return stage(REC.train_features(stage(REC.split_features(train, test, REC.PARITY), "rows"), REC.PARITY), "features")
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    cut, plain = rows(11), rows(1)
    columns = sorted(cut.columns)
    assert cut.select(columns).exceptAll(plain.select(columns)).count() == 0
    assert cut.count() == plain.count() == train.count()


@pytest.fixture(scope="module")
def tiny(spark):
    rows = [(1, 10, "2024-06-01 10:00:00", 3, 5, 100), (2, 10, "2024-06-01 10:05:00", 3, 5, 101), (3, 11, "2024-06-01 11:00:00", -1, 6, 100)]
    return spark.createDataFrame(rows, "interaction_id long, session_id long, ts string, user_id long, country smallint, partnumber int").select(
        "interaction_id", "session_id", F.to_timestamp_ntz("ts").alias("timestamp_local"), "user_id", "country", "partnumber")


def test_all_sources(spark, tiny):
    sources = dict(
        top_global=spark.createDataFrame([(200, 9), (100, 8)], "partnumber int, score long"),
        by_country=spark.createDataFrame([(5, 200), (6, 300)], "country smallint, partnumber int"),
        by_user=spark.createDataFrame([(3, 200), (3, 200)], "user_id long, partnumber int"),
        similar=spark.createDataFrame([(100, 200), (101, 200)], "partnumber long, neighbour long"),
    )
    by_row = C.extend_test(tiny, **sources)
    # 10: 200 as global/similar, country and user row, 100; 11: 200, 100, 300
    made = by_row.filter("synthetic_candidate = 1")
    assert made.filter("session_id = 10").count() == 4 and made.filter("session_id = 11").count() == 3
    items = C.extend_test(tiny, dedupe="item", **sources).filter("synthetic_candidate = 1")
    got = {(r.session_id, r.partnumber): r.sources for r in items.collect()}
    assert got[(10, 200)] == ["country", "global", "similar", "user"]
    assert len(got) == 5
    filled = C.fill_candidates(by_row).filter("synthetic_candidate = 1").collect()
    assert {str(r.timestamp_local) for r in filled if r.session_id == 10} == {"2024-06-01 10:05:00"}
    assert {r.user_id for r in filled if r.session_id == 11} == {-1}
    with pytest.raises(ValueError):
        C.extend_test(tiny)
