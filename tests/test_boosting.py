import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartloom.operators import boosting as B
from cartloom.operators.evaluate import ndcg_at_k


def brute_gradients(score, label, row, k):
    """All pairs of one session."""
    order = sorted(range(len(score)), key=lambda i: (-score[i], row[i]))
    discount = {i: 1 / math.log2(n + 2) if n < k else 0.0 for n, i in enumerate(order)}
    ideal = sum(1 / math.log2(n + 2) for n in range(min(k, sum(label))))
    g, h = np.zeros(len(score)), np.zeros(len(score))
    for i in range(len(score)):
        for j in range(len(score)):
            if label[i] == 1 and label[j] == 0:
                change = abs(discount[i] - discount[j]) / ideal
                rho = 1 / (1 + math.exp(score[i] - score[j]))
                g[i] -= rho * change
                g[j] += rho * change
                h[i] += rho * (1 - rho) * change
                h[j] += rho * (1 - rho) * change
    return g, h


def sessions(draw, count, longest):
    out = []
    for s in range(count):
        for _ in range(draw.randint(1, longest)):
            a, b = draw.random(), draw.choice([None, 0.0, 1.0, 2.0])
            c = draw.choice(["x", "y", None, "z"])
            wish = 2 * a + (1.0 if b is None else 0.3 * b) + (0.8 if c == "y" else 0.0)
            out.append((s, len(out), a, b, c, int(wish + draw.gauss(0, 0.5) > 2.2)))
    return out


SCHEMA = "session_id bigint, interaction_id bigint, a double, b double, c string, add_to_cart int"


@pytest.mark.parametrize("chunk", [4096, 3])
def test_gradients_equal_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(B, "CHUNK", chunk)
    rows = sessions(random.Random(1), 25, 14)
    df = spark.createDataFrame(rows, SCHEMA)
    bins = B.find_bins(df, ["a", "b", "c"], 20)
    table = B.chunks(df, bins, [F.lit(B.TRAIN), F.when(F.col("session_id") % 2 == 0, B.TRAIN).otherwise(B.HELD)])
    stump = B.Tree()
    stump.value[0] = 0.0
    left, right = stump.split(0, 0, 9, False, 1.0)
    stump.value[left], stump.value[right] = -0.4, 0.7
    settings = B.Settings(row_share=1.1)
    trees = [[stump], []]
    state = table.withColumn("base", F.unhex(F.array_join(F.transform("row", lambda r: F.lit("0" * 32)), "")))
    best = state.mapInArrow(B._best_rows(2, trees, 5), "session_id bigint, model int, less double, row bigint, label int, x binary")
    tops = best.groupBy("session_id").agg(F.sort_array(F.collect_list(F.struct("model", "less", "row", "label", "x"))).alias("tops"))
    found = state.join(tops, "session_id").mapInArrow(B._gradients(2, trees, 0, settings), B._GRADS).collect()
    got = {}
    for r in found:
        if r["x"] is not None:
            sums = got.setdefault(bytes(r["x"]), np.zeros((2, 2)))
            sums += np.stack([np.frombuffer(r["g"]), np.frombuffer(r["h"])])
    want, quality = {}, {}
    x_of = {}
    for r in table.select("session_id", F.explode(F.arrays_zip("row", "label", "x")).alias("r")).collect():
        x_of[r["r"]["row"]] = bytes(r["r"]["x"])
    for s in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == s]
        label, row = [r[5] for r in own], [r[1] for r in own]
        for m in range(2):
            score = [(0.7 if x_of[i][0] > 9 else -0.4) if m == 0 else 0.0 for i in row]
            ideal = sum(1 / math.log2(n + 2) for n in range(min(5, sum(label))))
            order = sorted(range(len(own)), key=lambda i: (-score[i], row[i]))
            quality.setdefault(m, []).append((s, sum(label[i] / math.log2(n + 2) for n, i in enumerate(order[:5])) / ideal if ideal else 0.0))
            if sum(label) and (m == 0 or s % 2 == 0):
                for i, g, h in zip(row, *brute_gradients(score, label, row, 5), strict=True):
                    sums = want.setdefault(x_of[i], np.zeros((2, 2)))
                    sums[0, m] += g
                    sums[1, m] += h
    for x, sums in want.items():
        assert np.allclose(sums, got.get(x, 0), atol=1e-9)
    assert all(np.allclose(v, 0, atol=1e-9) for x, v in got.items() if x not in want)
    sums = {}
    for r in found:
        if r["x"] is None:
            t = sums.setdefault((r["model"], r["role"]), [0.0, 0])
            t[0] += r["total"]
            t[1] += r["sessions"]
    assert sums[0, B.TRAIN] == pytest.approx([sum(q for _, q in quality[0]), 25])
    assert sums[1, B.HELD] == pytest.approx([sum(q for s, q in quality[1] if s % 2), 12])


def reference_tree(x, g, h, settings):
    """Best-first on one machine, one leaf at a time, trying every feature and bin."""
    tree, leaves = B.Tree(), {0: np.arange(len(x))}

    def best(rows):
        out = None
        for f in range(x.shape[1]):
            sums = np.zeros((3, settings.bins + 1))
            for part, weight in enumerate((g, h, np.ones(len(x)))):
                np.add.at(sums[part], x[rows, f], weight[rows])
            found = B.best_split(sums, settings.least_rows, settings.least_hessian)
            if found and (out is None or found[0] > out[1][0]):
                out = (f, found)
        return out

    splits = {0: best(leaves[0])}
    while len(leaves) < settings.leaves:
        open_ = [(-s[1][0], n) for n, s in splits.items() if s and n in leaves]
        if not open_:
            break
        node = min(open_)[1]
        f, found = splits[node]
        rows = leaves.pop(node)
        left, right = tree.split(node, f, found[1], found[2], found[0])
        value = x[rows, f]
        goes = np.where(value == 0, found[2], value <= found[1])
        for child, own in ((left, rows[goes]), (right, rows[~goes])):
            leaves[child] = own
            splits[child] = best(own)
    for node, rows in leaves.items():
        tree.value[node] = -g[rows].sum() / (h[rows].sum() + 1e-9) * settings.rate
    return tree


@pytest.mark.parametrize("leaves", [2, 7, 31])
def test_tree_equals_reference(spark, leaves):
    rng = np.random.default_rng(leaves)
    x = rng.integers(0, 12, (700, 4)).astype(np.uint8)
    # Sums of whole numbers are the same in any order.
    g = (np.where(x[:, 1] > 6, 40, -30) + np.where(x[:, 2] == 0, 90, 0) + 5 * x[:, 0] * (x[:, 3] > 4) + rng.integers(-20, 20, 700)).astype(np.float64)
    h = rng.integers(1, 4, 700).astype(np.float64)
    settings = B.Settings(leaves=leaves, least_rows=15, bins=12, feature_share=1.0)
    rows = [(a.tobytes(), b.tobytes(), c.tobytes(), b"\x01") for a, b, c in zip(x, g[:, None], h[:, None])]
    frame = spark.createDataFrame(rows, "x binary, g binary, h binary, n binary").repartition(5)
    (tree,) = B.grow(frame, [0], 1, 4, 0, settings)
    want = reference_tree(x, g, h, settings)
    assert sum(f < 0 for f in tree.feature) == sum(f < 0 for f in want.feature) <= leaves
    assert np.allclose(tree.values(x), want.values(x))
    assert sorted(zip(tree.feature, tree.bin)) == sorted(zip(want.feature, want.bin))


def test_nulls_take_the_better_side():
    sums = np.zeros((3, 4))
    sums[0], sums[1], sums[2] = [-9, -10, 0, 12], [30, 30, 30, 30], [30, 30, 30, 30]
    assert B.best_split(sums, 10, 0)[2] is True
    sums[0] = [9, -10, 0, 12]
    assert B.best_split(sums, 10, 0)[2] is False
    assert B.best_split(sums, 70, 0) is None


def test_learns_order_and_stops(spark):
    rows = sessions(random.Random(4), 160, 12)
    df = spark.createDataFrame(rows, SCHEMA)
    bins = B.find_bins(df, ["a", "b", "c"], 30)
    fold = F.col("session_id") % 4
    role = [F.when(fold == m, B.HELD).when(fold == m + 1, B.WATCH).otherwise(B.TRAIN) for m in range(2)]
    settings = B.Settings(rounds=12, rate=0.3, leaves=6, least_rows=10, patience=4)
    seen = []
    models = B.boost(B.chunks(df, bins, role), bins, 2, settings, lambda turn, quality: seen.append(quality))
    assert len(models) == 2 and all(len(m.trees) >= 1 for m in models)
    for m, model in enumerate(models):
        assert max(model.watched) == model.watched[len(model.trees)]
        held = ndcg_at_k(B.predict(df.filter(fold == m), model)).first()["ndcg"]
        plain = ndcg_at_k(df.filter(fold == m).withColumn("score", F.lit(0.0))).first()["ndcg"]
        assert held > plain + 0.05
        assert model.importance()["a"] > model.importance()["c"] > 0
    assert B.predict(df.limit(0), models[0]).count() == 0
    (classes,) = B.boost(B.chunks(df, bins, [F.lit(B.TRAIN)]), bins, 1, B.Settings(objective="logistic", rounds=4, rate=0.5, leaves=6, least_rows=10, patience=99))
    assert len(classes.trees) == 4
    means = {r["add_to_cart"]: r["m"] for r in B.predict(df, classes).groupBy("add_to_cart").agg(F.avg("score").alias("m")).collect()}
    assert means[1] > means[0] + 0.5


def test_blobs_without_python_objects():
    import pyarrow as pa

    rows = np.random.default_rng(1).normal(size=(50, 3))
    packed = B._packed(rows)
    assert packed.type == pa.binary() and packed.to_pylist() == [r.tobytes() for r in rows]
    # Slices that do not start at the first value.
    assert (B._unpacked(packed.slice(7, 20), np.float64).reshape(-1, 3) == rows[7:27]).all()
    assert len(B._unpacked(packed.slice(3, 0), np.uint8)) == 0


def test_places_of_rows():
    block = B._Block(*[np.empty(0)] * 3, np.array([0, 0, 0, 1, 1, 2]), np.array([3, 8, 9, 1, 8, 9]), *[np.empty(0)] * 3)
    assert block.places(np.array([0, 1, 1, 2, 2, 0]), np.array([8, 8, 9, 9, 100, -5])).tolist() == [1, 4, -1, 5, -1, -1]
