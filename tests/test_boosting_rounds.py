"""Rounds of boosting: where they read and write, long sessions, and judging all folds at once."""

import glob
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartloom.operators import boosting as B
from cartloom.operators import ranking as R
from cartloom.operators.evaluate import ndcg_at_k
from tests.test_boosting import SCHEMA, brute_gradients, reference_tree, sessions

FEATURES = ["a", "b", "c"]
SETTINGS = B.Settings(rounds=3, rate=0.3, leaves=6, least_rows=10, patience=9)


@pytest.fixture(scope="module")
def toy(spark):
    return spark.createDataFrame(sessions(random.Random(4), 160, 12), SCHEMA).repartition(3)


def roles():
    fold = F.col("session_id") % 4
    return [F.when(fold == m, B.HELD).when(fold == m + 1, B.WATCH).otherwise(B.TRAIN) for m in range(2)]


def test_rounds_move_no_rows_and_leave_no_tables(spark, toy, monkeypatch):
    bins = B.find_bins(toy, FEATURES, 30)
    plans, left, write = [], [], B.write_new

    def watched(df, name, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name, **options)

    def tables():
        folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
        return glob.glob(f"{folder}/staged-*/boosting-*")

    monkeypatch.setattr(B, "write_new", watched)
    before = len(tables())
    models = B.boost(B.chunks(toy, bins, roles()), bins, 2, SETTINGS, lambda turn, quality: left.append(len(tables()) - before))
    assert len(models) == 2 and len(plans) == 1 + 4
    assert not any("Exchange" in plan for plan in plans[1:])
    assert left == [1] * 4 and len(tables()) == before


def test_gradients_of_whole_sessions_equal_all_pairs():
    draw = random.Random(2)
    rows = [(s, [draw.choice([0.0, 0.5, 1.0, 1.5]) for _ in range(draw.randint(1, 14))]) for s in range(20)]
    scores = [np.array(v) for _, v in rows]
    labels = [np.array([int(draw.random() < 0.3) for _ in v]) for v in scores]
    counts = np.array([len(v) for v in scores], dtype=np.int32)
    ideal = np.array([sum(1 / np.log2(n + 2) for n in range(min(5, int(v.sum())))) for v in labels])
    row = np.arange(counts.sum())
    size = len(row)
    batch = pa.RecordBatch.from_arrays(
        [pa.nulls(1, pa.int64()), pa.array([0], pa.int32())]
        + [pa.array([v.tobytes()]) for v in (counts, np.full(20, B.TRAIN, dtype=np.uint8), ideal, row, np.concatenate(labels).astype(np.uint8), np.zeros((size, 1), dtype=np.uint8), np.concatenate(scores))]
        + [pa.nulls(1, pa.int32())],
        names=[*B._STATE_NAMES, "tops"],
    )
    made, sums = B._gradients(1, [[]], 0, B.Settings(row_share=1.1), written=True)(iter([batch]))
    g, h = (np.frombuffer(made.column(c)[0].as_py(), dtype=np.float32) for c in "gh")
    want = [brute_gradients(s, l, r, 5) if l.any() else (np.zeros(len(s)),) * 2 for s, l, r in zip(scores, labels, np.split(row, np.cumsum(counts)[:-1]))]
    assert np.allclose(g, np.concatenate([w[0] for w in want]), atol=1e-6)
    assert np.allclose(h, np.concatenate([w[1] for w in want]), atol=1e-6)
    assert sums.column("sessions").to_pylist()[B.TRAIN] == 20


def test_sessions_of_several_chunks_give_the_same_trees(toy, monkeypatch):
    bins = B.find_bins(toy, FEATURES, 30)
    whole = B.boost(B.chunks(toy, bins, roles()), bins, 2, SETTINGS)
    monkeypatch.setattr(B, "CHUNK", 4)
    spread = B.boost(B.chunks(toy, bins, roles()), bins, 2, SETTINGS)
    for one, other in zip(whole, spread, strict=True):
        assert one.watched == pytest.approx(other.watched)
        assert [(t.feature, t.bin, t.nulls_left) for t in one.trees] == [(t.feature, t.bin, t.nulls_left) for t in other.trees]
        assert all(np.allclose(a.value, b.value, atol=1e-5) for a, b in zip(one.trees, other.trees))


@pytest.mark.parametrize("local", [0, 300, 10000])
def test_leaves_of_few_rows_are_grown_by_one_task(spark, monkeypatch, local):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 12, (700, 4)).astype(np.uint8)
    g = (np.where(x[:, 1] > 6, 40, -30) + np.where(x[:, 2] == 0, 90, 0) + 5 * x[:, 0] * (x[:, 3] > 4) + rng.integers(-20, 20, 700)).astype(np.float64)
    h = rng.integers(1, 4, 700).astype(np.float64)
    settings = B.Settings(leaves=31, least_rows=5, bins=12, feature_share=1.0)
    frame = spark.createDataFrame([(a.tobytes(), b.tobytes(), c.tobytes(), b"\x01") for a, b, c in zip(x, g, h)], "x binary, g binary, h binary, n binary").repartition(5)
    monkeypatch.setattr(B, "LOCAL", local)
    passes, added = [], B._added
    monkeypatch.setattr(B, "_added", lambda *a: passes.append(1) or added(*a))
    (tree,) = B.grow(frame, [0], 1, 4, 0, settings, 700)
    want = reference_tree(x, g, h, settings)
    assert sorted(zip(tree.feature, tree.bin)) == sorted(zip(want.feature, want.bin)) and np.allclose(tree.values(x), want.values(x))
    assert len(passes) == 1 if local > 700 else len(passes) > 1


def test_only_the_smaller_side_is_added_up(monkeypatch):
    monkeypatch.setattr(B, "LOCAL", 0)
    growth = B.Growth(B.Settings(leaves=8, least_rows=5, bins=6), np.arange(2))
    rng = np.random.default_rng(3)
    x, g, h = rng.integers(1, 7, (200, 2)), rng.integers(-9, 9, 200).astype(float), rng.integers(1, 4, 200).astype(float)

    def sums(rows):
        return np.stack([np.stack([np.bincount(x[rows, f], weights=w[rows], minlength=7) for f in range(2)]) for w in (g, h, np.ones(200))])

    growth.add({0: sums(np.arange(200))})
    left, right = growth.ahead[0]
    assert set(growth.pending) == {left, right} and len(growth.asked()) == 1
    own = dict(growth.tree.reach(x.T, np.arange(200)))
    asked, = growth.asked()
    assert len(own[asked]) <= 100
    growth.add({asked: sums(own[asked])})
    assert all((growth.sums[n] == sums(own[n])).all() for n in (left, right))


def test_without_watched_rows_rounds_end_when_nothing_splits(toy):
    few = toy.filter("session_id < 3")
    bins = B.find_bins(few, FEATURES, 30)
    turns = []
    model, = B.boost(B.chunks(few, bins, [F.lit(B.TRAIN)]), bins, 1, B.Settings(rounds=40, least_rows=500, patience=2), lambda turn, _: turns.append(turn))
    assert model.trees == () and turns == [0, 1, 2]


def test_all_folds_are_judged_as_each(toy, monkeypatch):
    found, boost, calls, predict = [], B.boost, [], B.predict_all
    monkeypatch.setattr(B, "boost", lambda *a, **k: found.extend(boost(*a, **k)) or found)
    monkeypatch.setattr(B, "predict_all", lambda *a, **k: calls.append(1) or predict(*a, **k))
    rows = {r["fold"]: r for r in R.cross_validate_ndcg(toy, 3, SETTINGS, features=FEATURES).collect()}
    assert len(calls) == 1 and sorted(rows) == [0, 1, 2]
    folded = R.group_folds(toy, 3)
    for fold, model in enumerate(found):
        scored = B.predict(folded, model)
        assert rows[fold]["rounds"] == len(model.trees)
        assert rows[fold]["train"] == pytest.approx(ndcg_at_k(scored.filter(F.col("fold") != fold)).first()["ndcg"])
        assert rows[fold]["valid"] == pytest.approx(ndcg_at_k(scored.filter(F.col("fold") == fold)).first()["ndcg"])
