"""Windows over cut keys give what plain windows give."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartloom.functions.numbers import seconds_between
from cartloom.operators import candidates as C
from cartloom.operators import interactions as I
from cartloom.operators import sessions as S
from cartloom.operators.analytics import avg_visits_before_add
from cartloom.operators.ordered import PART, dealt, windowed
from cartloom.operators.quantiles import exact_quantiles
from cartloom.operators.sampling import sample_rows


@pytest.fixture(scope="module")
def rows(spark):
    """Key 1 holds a third of the rows; some equal times."""
    rnd = random.Random(5)
    data = [(rnd.choice([1, 1, 2, 3, 4, 5]), rnd.randrange(40), i, rnd.randrange(5)) for i in range(600)]
    return spark.createDataFrame(data, "k long, t long, id long, v long").cache()


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Small tables in many partitions, so that keys cross borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("falling", [False, True])
def test_windowed(rows, falling):
    sign = F.col("t").desc() if falling else F.col("t").asc()
    order = [sign, F.col("id").asc()]
    extra = {} if falling else {"previous": {"p": "t"}, "following": {"f": "t"}, "position": ["t", "id"]}
    got = windowed(
        rows, ["k"], order, running={"run": F.col("v"), "nth": F.lit(1)},
        overall={"lo": ("min", "t"), "hi": ("max", "t"), "n": ("count", "t"), "s": ("sum", "v")}, **extra,
    )
    same(got, plain(rows, ["k"], order, neighbours=not falling).select(*got.columns))


def plain(rows, keys, order, neighbours=True):
    """The same columns from windows over whole keys."""
    w = Window.partitionBy(*keys).orderBy(*order)
    so_far, whole = w.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*keys)
    return rows.withColumns({
        "run": F.sum("v").over(so_far), "nth": F.row_number().over(w),
        **({"p": F.lag("t").over(w), "f": F.lead("t").over(w)} if neighbours else {}),
        "lo": F.min("t").over(whole), "hi": F.max("t").over(whole), "n": F.count("t").over(whole), "s": F.sum("v").over(whole),
    })


@pytest.mark.parametrize("kind", ["null times", "one time", "null keys", "large ids", "one key"])
def test_nothing_is_a_special_case(spark, kind):
    rnd = random.Random(kind)
    data = []
    for i in range(400):
        k = {"null keys": rnd.choice([None, None, 1, 2]), "large ids": 4 * 10**9 + i // 3, "one key": 5}.get(kind, rnd.randrange(3))
        t = {"null times": rnd.choice([None, None, 3, 8]), "one time": 60}.get(kind, rnd.randrange(50))
        data.append((k, t, i, rnd.randrange(4)))
    rows = spark.createDataFrame(data, "k long, t long, id long, v long")
    order = [F.col("t").asc(), F.col("id").asc()]
    got = windowed(
        rows, ["k"], order, running={"run": F.col("v"), "nth": F.lit(1)}, previous={"p": "t"}, following={"f": "t"}, position=["t", "id"],
        overall={"lo": ("min", "t"), "hi": ("max", "t"), "n": ("count", "t"), "s": ("sum", "v")},
    )
    same(got, plain(rows, ["k"], order).select(*got.columns))


def test_one_partition_never_holds_a_hot_key(rows):
    parts = dealt(rows, ["k"], [F.col("t"), F.col("id")]).groupBy(PART).count().collect()
    assert len(parts) == 13 and max(r["count"] for r in parts) < 150


def test_source_is_read_twice_at_most(spark, tmp_path, rows):
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    plan = windowed(spark.read.parquet(path), ["k"], [F.col("id")], running={"n": F.lit(1)})._jdf.queryExecution().toString()
    assert path not in plan


def test_nulls_in_session_columns(clicks):
    """Null times and null products give the same counts as plain windows."""
    holes = clicks.withColumns({
        "timestamp_local": F.when(F.col("interaction_id") % 3 > 0, F.col("timestamp_local")),
        "partnumber": F.when(F.col("interaction_id") % 4 > 0, F.col("partnumber")),
    })
    by = Window.partitionBy("session_id", "partnumber").orderBy("timestamp_local", "interaction_id")
    same(S.product_touch_index(holes), holes.withColumn("product_interaction_count", F.row_number().over(by)))
    sizes = S.session_row_features(holes).select("interaction_id", "total_session_interactions")
    same(sizes, holes.select("interaction_id", F.count("timestamp_local").over(Window.partitionBy("session_id")).alias("total_session_interactions")))


@pytest.fixture(scope="module")
def clicks(spark):
    rnd = random.Random(9)
    data = []
    for i in range(500):
        session = rnd.choice([7, 7, 7, 1, 2, 3, 4, 5, 6])
        minute, second = rnd.randrange(60), rnd.randrange(3)
        data.append((i, session, f"2024-06-01 10:{minute:02d}:0{second}", None if session % 2 == 0 else session % 3,
                     3, rnd.randrange(4), rnd.randrange(2), int(session < 6), 1))
    return spark.createDataFrame(
        data, "interaction_id long, session_id long, ts string, user_id long, country smallint, partnumber int, "
        "add_to_cart int, flag int, pagetype smallint"
    ).withColumn("timestamp_local", F.to_timestamp_ntz("ts")).drop("ts").withColumn("device_type", F.lit(1).cast("smallint")).cache()


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    left, right = (sorted(repr(tuple(r)) for r in x.select(*columns).collect()) for x in (a, b))
    assert left == right


def in_one_partition(spark, build):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        return build()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "13")


@pytest.mark.parametrize("build", [
    S.session_time_features, S.product_touch_index, avg_visits_before_add,
    lambda c: avg_visits_before_add(c, grain="session_product"),
    lambda c: I.running_counts(c.withColumn("user_id", F.coalesce("user_id", F.lit(-1)))),
    lambda c: I.running_counts(c.withColumn("user_id", F.coalesce("user_id", F.lit(-1))), strict_prior=True, carry_forward=True),
], ids=["times", "touches", "visits", "group visits", "counts", "strict counts"])
def test_results_do_not_depend_on_partitions(spark, clicks, build):
    same(build(clicks), in_one_partition(spark, lambda: build(clicks)))


@pytest.mark.parametrize("order", ["latest_first", "by_time"])
def test_candidate_touch_index_does_not_depend_on_partitions(spark, clicks, order):
    made = clicks.select("session_id").distinct().withColumn("partnumber", F.lit(2)).withColumn(
        "synthetic_candidate", F.lit(1).cast("long"))
    filled = C.fill_candidates(clicks.unionByName(made, allowMissingColumns=True))
    cut = C.candidate_touch_index(filled, order=order)
    same(cut, in_one_partition(spark, lambda: C.candidate_touch_index(filled, order=order)))
    first = cut.filter("session_id = 7 AND partnumber = 2 AND synthetic_candidate = 1").first()
    assert (first.product_interaction_count == 1) == (order == "latest_first")


def test_quantiles_leave_nan_out_and_know_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("nan")), (None, 2.0), ("a", None), ("a", 5.0)], "g string, x double")
    assert sorted((r.g or "", r.n, r.edges) for r in exact_quantiles(df, ["g"], "x", (0.5,)).collect()) == [("", 2, [1.5]), ("a", 1, [5.0])]


def test_exact_quantiles_match_pandas(spark):
    rnd = random.Random(3)
    data = [(rnd.choice("aab"), rnd.choice([rnd.uniform(-50, 900), 3.0])) for _ in range(997)]
    df = spark.createDataFrame(data, "g string, x double")
    pdf = df.toPandas()
    for g, edges in df.transform(lambda f: exact_quantiles(f, ["g"], "x", (0.1, 0.25, 0.5, 0.99))).select("g", "edges").collect():
        assert edges == pytest.approx(list(pdf[pdf.g == g].x.quantile([0.1, 0.25, 0.5, 0.99])))


@pytest.mark.parametrize("n", [0, 1, 17, 599, 600, 9999])
def test_sample_rows_is_exact_and_repeatable(rows, n):
    first = {r.id for r in sample_rows(rows, n, ["id"]).collect()}
    assert len(first) == min(n, 600)
    assert first == {r.id for r in sample_rows(rows.repartition(7), n, ["id"]).collect()}


def test_times_follow_the_wall_clock_in_any_zone(spark):
    """02:30 does not exist in Madrid on this day, but it is a valid local timestamp."""
    texts = ["2024-03-31 01:30:00", "2024-03-31 02:30:00.25", "2024-03-31 03:00:00", "1969-12-31 23:59:59"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", F.to_timestamp_ntz("t").alias("ts"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
        first = F.lit("2024-03-31 01:30:00").cast("timestamp_ntz")
        got = df.select("id", seconds_between(first, F.col("ts")).cast("double").alias("s")).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.s for r in got[:3]] == [0.0, 3600.25, 5400.0]
