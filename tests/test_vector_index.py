"""The quantised index: estimates against reconstructed vectors, recall with few lists looked into."""

import numpy as np
import pytest

from cartloom.operators import similarity as V, vector_index as VI


@pytest.fixture(scope="module")
def units():
    rows = np.random.default_rng(4).normal(size=(300, 7))
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def frame(spark, rows, start=0):
    return spark.createDataFrame([(start + i, [float(x) for x in r]) for i, r in enumerate(rows)], "partnumber int, embedding array<double>")


def test_estimates_are_products_with_rebuilt_vectors(spark, units):
    table = spark.createDataFrame([(i, [float(x) for x in u]) for i, u in enumerate(units)], "rep long, unit array<double>")
    index = VI.train(table, 3, stretch=2, codes=16)
    lists, codes = index.encode(units)
    assert codes.shape == (300, 4) and set(lists) == {0, 1, 2}
    rebuilt = index.centres[lists] + np.concatenate([index.books[m][codes[:, m]] for m in range(4)], axis=1)[:, :7]
    for centre in range(3):
        mine = lists == centre
        assert np.allclose(index.scores(units[:20], centre, codes[mine]), units[:20] @ rebuilt[mine].T)


def test_recall_and_work(spark, monkeypatch):
    # Small parts and blocks, so that a hot list (a third of the vectors) is cut.
    monkeypatch.setattr(VI, "QUERY_ROWS", 100)
    monkeypatch.setattr(VI, "LIST_ROWS", 150)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(10, 12))
    of = np.concatenate([np.zeros(400, dtype=int), rng.integers(1, 10, size=800)])
    table = frame(spark, np.vstack([centres[of] + 0.3 * rng.normal(size=(1200, 12)), np.zeros((1, 12))])).cache()
    found = V.index_report(table, 5, VI.Settings(lists=16, probes=4)).first()
    assert found.pairs == 6005 and found.recall >= 0.9
    assert found.exact_products * 10 <= found.all_products
    exact = {(r.partnumber, r.neighbour): r.cosine for r in V.top_k_similar(table, 5).collect()}
    got = {(r.partnumber, r.neighbour): r.cosine for r in V.top_k_similar_indexed(table, 5, VI.Settings(lists=16, probes=4)).collect()}
    assert all(exact[p] == got[p] for p in exact.keys() & got.keys())


def test_few_odd_and_no_vectors(spark):
    same = frame(spark, [[1.0, 2.0, 3.0]] * 3)
    assert {(r.partnumber, r.neighbour) for r in V.top_k_similar_indexed(same, 2).collect()} == {(a, b) for a in range(3) for b in range(3) if a != b}
    assert V.top_k_similar_indexed(frame(spark, [[0.0, 0.0]])).count() == 0
    assert V.top_k_similar_indexed(same.filter("partnumber < 0")).count() == 0


def test_short_lists_travel_with_few_vectors(spark, units):
    """Exact products: each vector meets a list once, however many entries of its short list are there."""
    table = spark.createDataFrame([(i, [float(x) for x in u]) for i, u in enumerate(units)], "rep long, unit array<double>").cache()
    index = VI.train(table, 3)
    cells = VI._cells(table, VI.build(table, index).cache(), index, 3)
    short = VI._short_lists(cells, index, 20).cache()
    assert short.count() == 300 and {len(r.short) for r in short.collect()} == {20}
    exact = VI._exact(short, table, cells, 5)
    assert exact.count() <= 3 * 300
    best = {r.rep: sorted(zip(r.less, r.others)) for r in V._best(exact, 5).groupBy("rep").agg(
        V.F.collect_list(-V.F.col("cosine")).alias("less"), V.F.collect_list("other").alias("others")).collect()}
    listed = {r.rep: {e.others for e in r.short} for r in short.collect()}
    assert all(len(b) == 5 and {o for _, o in b} <= listed[rep] for rep, b in best.items())
